"""The synthetic grid over the driver's tables, in Spark and in SQL.

A pixel is a part (50 columns), an observation a line item of it: the date is
the shipping date, bands are its amounts, clear ones have a tax under 0.07.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 50
SPLIT = "1998-06-01"
LEVELS = (0.02, 0.05, 0.08)

OBS = f"""obs AS (SELECT (l_partkey // {WIDTH})::INT AS "row", (l_partkey % {WIDTH})::INT AS col, l_shipdate::DATE AS date, l_linenumber AS scl,
  l_suppkey AS tile, l_quantity AS q, l_extendedprice AS p, l_discount AS v, l_tax AS tax, l_tax < 0.07 AS clear, l_linestatus AS st,
  CASE WHEN l_shipdate::DATE < DATE '{SPLIT}' THEN 'was' ELSE 'now' END AS period FROM lineitem)"""
PIXELS = f"""px AS (SELECT (p_partkey // {WIDTH})::INT AS "row", (p_partkey % {WIDTH})::INT AS col, p_retailprice AS z, p_size AS s FROM part)"""
FREQ = """fr AS (SELECT "row", col, count(*) FILTER (clear) AS n, count(*) FILTER (clear AND v > 0.05) AS k FROM obs GROUP BY ALL)"""
WATER = """wt AS (SELECT "row", col FROM fr WHERE n >= 2 AND k / n >= 0.5)"""
EDGES = """ed AS (SELECT a."row" * 2147483648 + a.col AS a, b."row" * 2147483648 + b.col AS b FROM wt a JOIN wt b ON abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1)"""
REACH = """t(id, lab) AS (SELECT "row" * 2147483648 + col, "row" * 2147483648 + col FROM wt UNION SELECT ed.b, t.lab FROM t JOIN ed ON t.id = ed.a),
rg AS (SELECT id // 2147483648 AS "row", id % 2147483648 AS col, min(lab) AS region FROM t GROUP BY id)"""
PERIODS = """pf AS (SELECT "row", col, count(*) FILTER (clear AND period = 'was') AS na, count(*) FILTER (clear AND period = 'was' AND v > 0.05) AS ka,
  count(*) FILTER (clear AND period = 'now') AS nb, count(*) FILTER (clear AND period = 'now' AND v > 0.05) AS kb,
  sum(round(v * 100)::BIGINT) FILTER (period = 'was') / count(*) FILTER (period = 'was') / 100 AS ma, sum(round(v * 100)::BIGINT) FILTER (period = 'now') / count(*) FILTER (period = 'now') / 100 AS mb, sum(round(tax * 100)::BIGINT) FILTER (period = 'was') / count(*) FILTER (period = 'was') / 100 AS ta, sum(round(tax * 100)::BIGINT) FILTER (period = 'now') / count(*) FILTER (period = 'now') / 100 AS tb FROM obs GROUP BY ALL)"""
CHANGE = """ch AS (SELECT "row", col, CASE
  WHEN ka / na < 0.5 AND kb / nb >= 0.5 THEN (CASE WHEN (("row" + col) % 7) = 0 THEN 5 ELSE 1 END)
  WHEN ka / na >= 0.5 AND kb / nb < 0.5 THEN 2
  WHEN ka / na < 0.5 AND kb / nb < 0.5 AND (mb - ma) * 20 < -0.15 THEN 3
  WHEN kb / nb < 0.5 AND tb > 0.04 + 0.01 AND ta <= 0.05 THEN 4 ELSE 0 END AS cls FROM pf WHERE na >= 2 AND nb >= 2)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select(
        F.expr(f"cast(l_partkey div {WIDTH} as int)").alias("row"), F.expr(f"cast(l_partkey % {WIDTH} as int)").alias("col"), F.to_date("l_shipdate").alias("date"), F.col("l_linenumber").alias("scl"),
        F.col("l_suppkey").alias("tile"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p"), F.col("l_discount").alias("v"), F.col("l_tax").alias("tax"), (F.col("l_tax") < 0.07).alias("clear"),
        F.col("l_linestatus").alias("st"), F.when(F.to_date("l_shipdate") < F.lit(SPLIT).cast("date"), "was").otherwise("now").alias("period"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part")
    return t.select(F.expr(f"cast(p_partkey div {WIDTH} as int)").alias("row"), F.expr(f"cast(p_partkey % {WIDTH} as int)").alias("col"), F.col("p_retailprice").alias("z"), F.col("p_size").alias("s"))


def shape(cells: DataFrame) -> tuple[int, int]:
    r, c = cells.agg(F.max("row"), F.max("col")).first()
    return r + 1, c + 1


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and means of both periods of each cell."""
    o = observations(spark, sf_dir)
    a, b = F.col("period") == "was", F.col("period") == "now"
    wet = F.col("clear") & (F.col("v") > 0.05)
    # amounts are in hundredths: sums of integers are the same in any order
    mean = lambda when, c: F.sum(F.when(when, F.round(F.col(c) * 100).cast("long"))) / F.count_if(when) / 100
    return o.groupBy("row", "col").agg(
        F.count_if(F.col("clear") & a).alias("na"), F.count_if(wet & a).alias("ka"), F.count_if(F.col("clear") & b).alias("nb"), F.count_if(wet & b).alias("kb"),
        mean(a, "v").alias("ma"), mean(b, "v").alias("mb"), mean(a, "tax").alias("ta"), mean(b, "tax").alias("tb"),
    )
