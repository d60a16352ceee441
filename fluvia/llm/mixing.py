"""Mixing sources to target weights by balanced sampling with the cube method.

A source's documents are all wanted ``target / source_size`` times, a number
from 0 to 2. The whole part is taken as it is; the fraction is an inclusion
probability. The flight moves the probabilities of three documents at a time
along the null-space of the constraints (sum of probabilities, sum of sizes)
until one becomes 0 or 1, so totals of documents and of words stay exact. It
runs in blocks of ``BLOCK_ROWS`` documents; the at most two that stay open in
each block, and its ``HELD`` smallest, which wait, meet in the next round's
blocks, until a source has one block. Its last two documents, and up to
``REPAIRS`` settled ones of that block where a document far larger than the
others keeps the sum off, are the landing problem: they are rounded so that the
words end nearest to the target, at the cost of the total of documents. Without
repairs words of a source were off by up to 13 % on 1,000 documents, with them
by 0.1 %.

Rows are dealt to blocks by a hash of id, source and text and by their number
among equal rows, so neither rows without doc_id nor those of one id meet in one
block. Null text has size 0; null source is a source of its own, the last.
Repeated rows count each time. Rows of size 0 are taken with 0 words. Other
columns aren't read. The draw is a function of the rows: reruns agree. An empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.llm import _blocks as B
from fluvia.llm import _text as T

BLOCK_ROWS = 512
#: Smallest documents of a block that wait for the next round.
HELD = 8
#: Documents of the last block that the landing may turn besides those left open.
REPAIRS = 4
#: Fixed values of the mix.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0


def _hash() -> Column:
    """Tells rows apart by id, source and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, hash, size): words of each document."""

    def run(batches):
        for batch in batches:
            buf, offs = T.utf8(batch["text"])
            n = [T.Words(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]).counts for a, b in T.chunks(offs)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["source"], batch["hash"], pa.array(np.concatenate(n) if n else [], pa.int64())], ["doc_id", "source", "hash", "size"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _hash().alias("hash"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, hash long, size long")


def numbered(totals: DataFrame) -> DataFrame:
    """Sources with their place in code-point order, null last, without gathering them in one task."""
    parts = B.written(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    counts = {r.part: r.n for r in parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, at = {}, 0
    for p in sorted(counts):
        before[p], at = at, at + counts[p]
    offset = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("part")] if before else F.lit(0)
    w = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.withColumn("place", offset + F.row_number().over(w) - 1).drop("part")


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, n_rows, source_size, target): a budget dealt by weight; what is over ``most`` times a source's size goes to the rest."""
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = B.written(numbered(totals).withColumn("weight", weight))
    cap = most * F.col("source_size")
    budget = share * float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level = 0.0  # words a unit of weight; sources that reach their cap below it stay there
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        used, open_weight = table.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        new = (budget - used) / open_weight if open_weight else level
        if not new > level:
            break
        level = new
    return table.select("source", "n_rows", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities to 0 or 1 until at most two are open, keeping the sums of p and of p * size."""
    p = p.tolist()
    s = size.astype(float).tolist()
    draws = iter(rng.random(3 * len(p) + 8).tolist())
    active: list[int] = []
    eps = 1e-9
    for new in range(len(p)):
        if eps < p[new] < 1 - eps:
            active.append(new)
        else:
            p[new] = float(round(p[new]))
        if len(active) < 3:
            continue
        i, j, k = active
        u = [s[k] - s[j], s[i] - s[k], s[j] - s[i]]
        if not any(u):
            u = [1.0, -1.0, 0.0]
        up = min((1 - p[x]) / v if v > 0 else p[x] / -v for x, v in zip(active, u, strict=True) if v)
        down = min(p[x] / v if v > 0 else (1 - p[x]) / -v for x, v in zip(active, u, strict=True) if v)
        step = up if next(draws) * (up + down) < down else -down
        for x, v in zip(active, u, strict=True):
            p[x] += step * v
            if p[x] <= eps:
                p[x] = 0.0
            elif p[x] >= 1 - eps:
                p[x] = 1.0
        active = [x for x in active if 0 < p[x] < 1]
    return np.array(p)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round what is open so that the sum of sizes ends nearest to the sum of p * size; ties: fewer documents."""
    at = np.flatnonzero((p > 0) & (p < 1))
    want = float((p[at] * size[at]).sum())
    best = min(range(1 << len(at)), key=lambda m: (abs(want - sum(float(size[x]) for k, x in enumerate(at) if m >> k & 1)), m.bit_count(), m))
    p = p.copy()
    p[at] = [best >> k & 1 for k in range(len(at))]
    over = float((p[at] * size[at]).sum()) - want
    for _ in range(REPAIRS):  # a document far larger than the rest can leave the sum off: turn those that make up for it best
        able = np.flatnonzero((size > 0) & (p == (1 if over > 0 else 0)))
        if not len(able):
            break
        x = able[np.argmin(np.abs(abs(over) - size[able]))]
        step = float(size[x]) * (1 if over > 0 else -1)
        if abs(over - step) >= abs(over):
            break
        p[x], over = 1 - p[x], over - step
    return p


OPEN = "doc_id long, source string, hash long, nth long, size long, source_size long, target double, whole int, p double, n_rows long"


def mixed(docs: DataFrame, seed: int = 0, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, source, hash, size, source_size, target, copies, taken)."""
    equal = sizes(docs).groupBy("doc_id", "source", "hash", "size").agg(F.count(F.lit(1)).alias("rows"))
    own = B.written(equal.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows"))
    totals = own.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    goal = B.written(targets(totals, weights, share, most))
    most_rows = goal.agg(F.max("n_rows")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = own.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = joined.withColumn("whole", F.floor(rate).cast("int")).withColumn("p", rate - F.floor(rate)).select(*[c.split()[0] for c in OPEN.split(", ")])
    settled: list[DataFrame] = []
    level = 0
    while True:
        last = most_rows <= BLOCK_ROWS
        blocks = F.greatest(F.ceil(F.col("n_rows") / BLOCK_ROWS), F.lit(1))

        def fly(table: pa.Table, level=level) -> pa.Table:
            ids, size = B.ids_of(table["doc_id"]), np.asarray(table["size"])
            key = T.mix(np.asarray(table["hash"]).view(np.uint64) + T.mix(np.asarray(table["nth"]).view(np.uint64) + np.uint64(seed + 1)))
            order = np.lexsort((ids, key, -size))
            rng = np.random.default_rng([seed, level, int(key.sum() & np.uint64(2**31 - 1))])
            table, size = table.take(pa.array(order)), size[order]
            p = np.asarray(table["p"]).copy()
            if len(p) and table["n_rows"][0].as_py() <= BLOCK_ROWS:  # all of the source's open rows are here
                p = landing(flight(p, size, rng), size)
            else:
                flies = np.ones(len(p), bool)
                flies[np.flatnonzero(size > 0)[-HELD:]] = False
                p[flies] = flight(p[flies], size[flies], rng)
            return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p))

        flown = rows.withColumn("blk", F.pmod(F.xxhash64("hash", "nth", F.lit(seed + level)), blocks)).groupBy("source", "blk").applyInArrow(_without_block(fly), OPEN)
        # a source of one block stays at one, and its open rows are looked at again each round
        flown = B.written(flown.withColumn("n_rows", (2 + HELD) * F.greatest(F.ceil(F.col("n_rows") / BLOCK_ROWS), F.lit(1))))
        if last:
            settled.append(flown)
            break
        settled.append(flown.where("p in (0, 1)"))
        rows = flown.where("p not in (0, 1)")
        most_rows = (2 + HELD) * math.ceil(most_rows / BLOCK_ROWS)
        level += 1
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    copies = (F.col("whole") + F.col("p")).cast("int")
    return out.select("doc_id", "source", "hash", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def _without_block(f):
    return lambda table: f(table.drop_columns(["blk"]) if "blk" in table.column_names else table)


def remixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Whole rows of docs as often as the mix takes them; equal rows (id, source and text) share what was drawn for them. Null ids, sources and texts are treated as by ``mixed``; an empty table gives no rows."""
    drawn = mixed(docs, seed).groupBy("doc_id", "hash").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).where("_copies > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), _hash().alias("key"))
    joined = rows.join(drawn, (F.col("key") == F.col("hash")) & F.col("id").eqNullSafe(F.col("doc_id")))
    nth = F.row_number().over(Window.partitionBy("key", "id").orderBy("key"))
    each = F.floor((F.col("_copies") + F.col("_rows") - nth) / F.col("_rows"))
    taken = joined.withColumn("each", each.cast("int")).where("each > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("each")))).select("row.*")
