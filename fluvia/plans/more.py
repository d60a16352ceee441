"""Queries over the grid that build on others: sub-pixel water, lines, merged maps, susceptibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluvia.operators import focal, ml, regions, stats, unmix, watermap
from fluvia.plans.grid import CHANGE, OBS, PERIODS, PIXELS, periods, pixels, shape, table
from fluvia.plans.maps import both_periods, change
from fluvia.plans.tables import _SITES, site_frame

#: Fixed value: blocks of the cross-validation.
BLOCKS = 6

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {PIXELS}, m AS (SELECT "row" // 2 AS r, col // 2 AS c, avg(s / 50.0) AS m FROM px GROUP BY ALL) SELECT px."row", px.col, round(least(greatest((z / 2000) * (s / 50.0) / nullif(m, 0), 0), 1), 6) AS sharp FROM px JOIN m ON r = "row" // 2 AND c = col // 2""")
def swir_sharpening(spark, d):
    x = pixels(spark, d).select("row", "col", (F.col("z") / 2000).alias("coarse"), (F.col("s") / 50.0).alias("fine"))
    return unmix.sharpened(x, "coarse", "fine").select("row", "col", F.round("sharp", 6).alias("sharp"))


def _window(size: int) -> str:
    r = size // 2
    return f"""(SELECT p."row", p.col, count(*) FILTER (n.s > 25) AS k, sum(n.z) FILTER (n.s > 25) AS t FROM px p, sh, (SELECT unnest(range({-r}, {r + 1})) AS dr) a, (SELECT unnest(range({-r}, {r + 1})) AS dc) b
  JOIN px n ON n."row" = least(greatest(p."row" + dr, 0), mr) AND n.col = least(greatest(p.col + dc, 0), mc) GROUP BY ALL)"""


@query(f"""WITH {PIXELS}, sh AS (SELECT max("row") AS mr, max(col) AS mc FROM px), md AS (SELECT CASE WHEN count(*) >= 10 THEN median(z) END AS m FROM px WHERE s > 25), a AS {_window(5)}, b AS {_window(9)}
SELECT a."row", a.col, round(CASE WHEN a.k >= 12 THEN a.t / a.k WHEN b.k >= 12 THEN b.t / b.k ELSE m END, 9) AS member FROM a JOIN b ON a."row" = b."row" AND a.col = b.col, md""")
def local_end_members(spark, d):
    x = pixels(spark, d)
    return unmix.end_members(x, "z", F.col("s") > 25, *shape(x), near=5, far=9, least=12).select("row", "col", F.round("member", 9).alias("member"))


@query(f"""WITH {PIXELS}, q AS (SELECT a."row", a.col, a.s AS a, b.s AS b, c.s AS c, d.s AS d FROM px a JOIN px b ON b."row" = a."row" AND b.col = a.col + 1 JOIN px c ON c."row" = a."row" + 1 AND c.col = a.col + 1 JOIN px d ON d."row" = a."row" + 1 AND d.col = a.col),
n AS (SELECT "row", col, ((a >= 25.5) <> (b >= 25.5))::INT + ((b >= 25.5) <> (c >= 25.5))::INT + ((c >= 25.5) <> (d >= 25.5))::INT + ((d >= 25.5) <> (a >= 25.5))::INT AS n FROM q) SELECT "row", col, (n // 2)::BIGINT AS pieces FROM n WHERE n > 0""")
def bank_line_cells(spark, d):
    x = pixels(spark, d).withColumn("s", F.col("s").cast("double"))
    return unmix.contour(x, "s", 25.5).groupBy("row", "col").agg(F.count(F.lit(1)).alias("pieces"))


@query()
def bank_line_length(spark, d):
    """Length of the line in each row of squares, on smoothed values."""
    x = pixels(spark, d).withColumn("s", F.col("s").cast("double"))
    smooth = focal.box_mean(x, "s", 3, *shape(x), out="f")
    lines = unmix.contour(smooth, "f", 25.0)
    return lines.groupBy("row").agg(F.sum(unmix.length(lines, 10.0)).alias("metres"))


@query(f"""WITH {_SITES}, g AS (SELECT s_suppkey AS sid, (s_suppkey * 197 % 20011)::DOUBLE AS x1, (s_suppkey * 611 % 20023)::DOUBLE AS y1, (s_suppkey * 197 % 20011 + s_suppkey % 900 - 450)::DOUBLE AS x2, (s_suppkey * 611 % 20023 + s_suppkey * 7 % 900 - 450)::DOUBLE AS y2 FROM supplier),
c AS (SELECT id, (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) AS qa, (x1 - x) * (x2 - x1) + (y1 - y) * (y2 - y1) AS qb, (x1 - x) * (x1 - x) + (y1 - y) * (y1 - y) - 250000 AS qc FROM s, g),
l AS (SELECT id, CASE WHEN qa > 0 AND qb * qb > qa * qc THEN (least(greatest((-qb + sqrt(qb * qb - qa * qc)) / qa, 0), 1) - least(greatest((-qb - sqrt(qb * qb - qa * qc)) / qa, 0), 1)) * sqrt(qa) ELSE 0 END AS l FROM c)
SELECT id, round(sum(l), 3) AS length FROM l GROUP BY id""")
def road_length(spark, d):
    k = F.col("s_suppkey")
    x1, y1 = k * 197 % 20011, k * 611 % 20023
    g = table(spark, d, "supplier").select(k.alias("sid"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"), (x1 + k % 900 - 450).cast("double").alias("x2"), (y1 + k * 7 % 900 - 450).cast("double").alias("y2"))
    return unmix.length_within(site_frame(spark, d).select("id", "x", "y"), g, "id", 500.0).withColumn("length", F.round("length", 3))


@query(f"""WITH {OBS}, {PERIODS}, {CHANGE}, m AS (SELECT ch."row", ch.col, CASE WHEN ch."row" % 5 = 0 THEN (CASE WHEN cls IN (1, 5, 2) THEN 0 ELSE cls END) ELSE cls END AS std, CASE WHEN ch."row" % 5 = 0 AND mb - ma > 0.004 THEN 1 WHEN ch."row" % 5 = 0 AND mb - ma < -0.004 THEN 2 END AS tst FROM ch JOIN pf USING ("row", col))
SELECT "row", col, coalesce(tst, std)::INT AS cls FROM m""")
def merged_map(spark, d):
    """A corridor's tested classes replace the standard water classes there."""
    p = periods(spark, d).select("row", "col", (F.col("mb") - F.col("ma")).alias("dm"))
    inside = F.col("row") % 5 == 0
    tested = F.when(inside & (F.col("dm") > 0.004), 1).when(inside & (F.col("dm") < -0.004), 2)
    merged = watermap.merged_class(F.col("cls"), inside, F.array(tested), F.lit(True))
    return change(spark, d).join(p, ["row", "col"]).select("row", "col", merged.cast("int").alias("cls"))


@query()
def detection_limits(spark, d):
    x = regions.written(both_periods(spark, d).select(stats.detection_limit(F.col("se")).alias("limit")))
    low, middle, high = stats.quantiles(x, "limit", (0.1, 0.5, 0.9))
    return x.agg(F.count("limit").alias("cells")).select("cells", *[F.lit(v).cast("double").alias(k) for k, v in (("p10", low), ("p50", middle), ("p90", high))])


def learning_rows(spark, d):
    x = pixels(spark, d)
    f = focal.slope(focal.box_mean(x.withColumn("v", F.col("s").cast("double")), "v", 5, *shape(x)), "z", 20.0)
    return f.select("row", "col", F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"), "v", "box_mean", "slope", "z", (F.col("box_mean") + F.col("v") / 10 > 29).cast("int").alias("label"))


@query()
def ml_scores(spark, d):
    """Out-of-block probabilities of six blocks, with the models' default sizes."""
    rows = ml.spatial_blocks(learning_rows(spark, d), BLOCKS)
    return ml.cross_validated(rows, lambda: ml.Susceptibility(["v", "box_mean", "slope", "z"]), BLOCKS)
