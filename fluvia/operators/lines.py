"""Bank lines: smoothing, chaining of contour pieces, choice of river lines, retreat between lines."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluvia.operators.focal import dilate, erode
from fluvia.operators.regions import CELL, merged, written
from fluvia.operators.spatial import within
from fluvia.operators.unmix import contour, length

#: Width of the smoothing, least share of a line near the river's edge, least length in metres, least points.
SIGMA, EDGE_STEPS, EDGE_SHARE, LEAST_METRES, LEAST_POINTS = 0.7, 3, 0.5, 300.0, 4
PATCH_REACH, BASE_REACH = 15.0, 500.0


def gaussian(cells: DataFrame, value: str, sigma: float = SIGMA, out: str = "smooth", truncate: float = 4.0) -> DataFrame:
    """A Gaussian of a full grid by rows, then columns; the edge is mirrored with its own cell, missing values are 0."""
    r = int(truncate * sigma + 0.5)
    weight = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    weight = [w / sum(weight) for w in weight]
    x = cells.withColumn("_v", F.coalesce(F.col(value), F.lit(0.0)))
    for line, axis in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(line).orderBy(axis)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # cells at the ends look into the line's first and last values, mirrored
        x = x.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_line", F.collect_list("_v").over(w.rowsBetween(-2 * r, 2 * r)))
        first = F.greatest(F.col("_i") - 2 * r, F.lit(0))
        total = F.lit(0.0)
        for k, g in zip(range(-r, r + 1), weight, strict=True):
            at = F.col("_i") + k
            mirrored = F.when(at < 0, -1 - at).when(at >= F.col("_n"), 2 * F.col("_n") - 1 - at).otherwise(at)
            held = F.least(F.greatest(mirrored, F.lit(0)), F.col("_n") - 1)
            total = total + g * F.get("_line", (held - first).cast("int"))
        x = x.withColumn("_v", total).drop("_i", "_n", "_line")
    return x.withColumn(out, F.col("_v")).drop("_v")


def chained(pieces: DataFrame) -> DataFrame:
    """Pieces (x1, y1, x2, y2) with line: pieces that share an end are one line, known by its smallest point."""
    spot = lambda x, y: F.xxhash64(F.round(x, 6), F.round(y, 6))
    p = written(pieces.withColumn("a", spot("x1", "y1")).withColumn("b", spot("x2", "y2")))
    top = merged(p.select("a", "b"))
    return p.join(top.withColumnRenamed("node", "a"), "a", "left").withColumn("line", F.coalesce("top", "a")).drop("a", "b", "top")


def bank_lines(cells: DataFrame, value: str, river: DataFrame, res: float, level: float = 0.5, least: float = LEAST_METRES) -> DataFrame:
    """Pieces (line, x1, y1, x2, y2, in cells) of the level's lines on the smoothed surface that follow the river's edge and are long enough."""
    pieces = written(chained(contour(gaussian(cells, value), "smooth", level)))
    edge = dilate(river, EDGE_STEPS).join(erode(river, EDGE_STEPS), CELL, "left_anti").withColumn("_on", F.lit(1.0))
    near = pieces.withColumn("row", F.bround("y1").cast("int")).withColumn("col", F.bround("x1").cast("int")).join(edge, CELL, "left")
    lines = near.groupBy("line").agg(F.avg(F.coalesce("_on", F.lit(0.0))).alias("share"), F.count(F.lit(1)).alias("n"), F.sum(length(near, res)).alias("metres"))
    return pieces.join(lines.where((F.col("share") >= EDGE_SHARE) & (F.col("n") >= LEAST_POINTS - 1) & (F.col("metres") >= least)), "line", "left_semi")


def line_lengths(pieces: DataFrame, res: float) -> DataFrame:
    return pieces.groupBy("line").agg(F.sum(length(pieces, res)).alias("metres"))


def retreat(patch_cells: DataFrame, base: DataFrame, current: DataFrame, res: float) -> DataFrame:
    """(region, retreat): the greatest distance from the current line's points at a patch to the nearest baseline piece around it; NULL without either."""
    metres = lambda df, *names: df.select(*[(F.col(c) * res).alias(c) for c in ("x1", "y1", "x2", "y2")], *names)
    cells = patch_cells.select("region", (F.col("col") * res).alias("x"), (F.col("row") * res).alias("y"))
    points = metres(current).select(F.col("x1").alias("px"), F.col("y1").alias("py"))
    at = within(cells, points, PATCH_REACH + res / 2).select("region", F.col("px").alias("x"), F.col("py").alias("y")).distinct()
    b = metres(base).withColumn("px", (F.col("x1") + F.col("x2")) / 2).withColumn("py", (F.col("y1") + F.col("y2")) / 2)
    pairs = within(at, b, BASE_REACH)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.least(F.greatest(F.coalesce(F.try_divide((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy, dx * dx + dy * dy), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    ex, ey = F.col("x1") + t * dx - F.col("x"), F.col("y1") + t * dy - F.col("y")
    nearest = pairs.groupBy("region", "x", "y").agg(F.min(ex * ex + ey * ey).alias("d2"))
    far = nearest.groupBy("region").agg(F.round(F.sqrt(F.max("d2")), 1).alias("retreat"))
    return patch_cells.select("region").distinct().join(far, "region", "left")
