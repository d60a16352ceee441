"""A corpus pipeline: classify, drop near copies, cut repeated passages, mix sources, encode.

Each stage takes all rows that the one before it kept and returns the columns of
documents; the last returns token ids. Further columns of the input are left out.
Null texts are empty: they have words for no stage, and are judged, kept, mixed (as
rows of size 0) and encoded (to no tokens) like any other. Rows without doc_id or
with a repeated one are judged each by its own text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluvia.llm import _blocks as B
from fluvia.llm import bpe, jaccard, mixing, quality, substring
from fluvia.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs.select(*COLUMNS), words=5, threshold=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.remixed(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs, vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [("quality classifier", classify), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages), ("mixing sources", mix), ("BPE encoding", encode)]

#: The classifier and the draw of the mix are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        # what a stage writes on its way, and its predecessor's rows, go once its own are written
        docs = B.settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        if before:
            B.remove(spark, before)
        before = B.latest()
    return STAGES[-1][1](spark, docs, sf_dir)
