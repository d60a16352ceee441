r"""Conversations as one text, and back, in DataFrame functions only.

Grammar::

    conversation = { turn }
    turn         = "### " role ": " body " </turn>" newline
    code         = "\b" (backslash) | "\h" (#) | "\l" (<) | "\c" (colon) | "\n" (newline)

A body is written as it is if the parser gives it back alike and no control
string stands in it; else its backslashes, # and < become codes, which leaves no
control string. Roles always use codes. The parser cuts at turn ends, takes the
role up to the first ": ", and turns codes into what they stand for, so it needs
to know nothing of what was escaped. A turn that doesn't survive the round trip
fails the query rather than being written.

Null role or text is empty; turns are in the order of turn (null first), role,
text; repeated rows are turns of their own; a null conv_id is a conversation.
Other columns aren't read. An empty table gives no rows. A conversation is one
value of the result, so its turns meet in one row; its size is that of the
longest conversation, not of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
CONTROLS = ("###", "</turn>")
BODY_CODES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_CODES = (*BODY_CODES, (":", "\\c"), ("\n", "\\n"))
TEST_TEXT = "\\### Assistant: </turn> ok"


def _coded(text: Column, codes) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _decoded(text: Column, codes) -> Column:
    for plain, code in reversed(codes):  # the backslash last: until then each backslash begins a code
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), _coded(role, ROLE_CODES), F.lit(MIDDLE), body, F.lit(CLOSE))


def pieces(text: Column) -> Column:
    """Turns as written, without their ends."""
    return F.filter(F.split(text, "\\Q" + CLOSE + "\\E", -1), lambda x: x != "")


def parsed(text: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), MIDDLE, 1)
        body = F.substr(piece, F.char_length(role) + F.lit(len(OPEN) + len(MIDDLE) + 1))
        return F.struct(_decoded(role, ROLE_CODES).alias("role"), _decoded(body, BODY_CODES).alias("text"))

    return F.transform(pieces(text), turn)


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the text of each conversation and the (start, length) of its assistant bodies in characters."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    source = F.array(F.struct("role", "text"))
    plain = rows.withColumn("first", rendered(F.col("role"), F.col("text")))
    clash = F.lit(False)
    for c in CONTROLS:
        clash = clash | F.contains("text", F.lit(c))
    plain = plain.withColumn("body", F.when(clash | (parsed(F.col("first")) != source), _coded(F.col("text"), BODY_CODES)).otherwise(F.col("text")))
    written = plain.withColumn("piece", rendered(F.col("role"), F.col("body")))
    written = written.withColumn("piece", F.when(parsed(F.col("piece")) == source, F.col("piece")).otherwise(F.raise_error(F.lit("a turn doesn't survive the round trip"))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    length = F.char_length("piece")
    placed = written.withColumn("end", F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    body = F.char_length("body")
    start = F.col("end") - F.lit(len(CLOSE)) - body
    span = F.when(F.col("role") == "assistant", F.struct(start.cast("int").alias("start"), body.cast("int").alias("length")))
    turns = placed.select("conv_id", F.col("end"), "piece", span.alias("span")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("end", "piece", "span"))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.col("turns.piece"), "").alias("formatted"), F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"))


def read_back(texts: DataFrame) -> DataFrame:
    """Digests of what the parser and the loss mask find in formatted conversations."""
    turns = parsed(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss", lambda s: _decoded(F.substr(F.col("formatted"), s["start"] + 1, s["length"]), BODY_CODES)), "")
    return texts.withColumn("_loss", loss).select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def test_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: both turns say what looks like the end of a turn."""
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TEST_TEXT).alias("text"))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
b AS (SELECT *, CASE WHEN contains(text, '###') OR contains(text, '</turn>') OR contains(text, '\b') OR contains(text, '\h') OR contains(text, '\l')
    THEN replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') ELSE text END AS body,
  replace(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'), chr(10), '\n') AS coded FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(coded) + length(body) + 15)::BIGINT AS formatted_chars
FROM b GROUP BY conv_id
"""
