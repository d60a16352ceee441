"""Comparison with labelled tiles and with published rates of river reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvia.operators.spatial import bounded_nearest

#: Least share of each class in a tile, least cells, least length of a reach, reach of a loss point.
LEAST_SHARE, LEAST_CELLS, LEAST_LENGTH, MOST_DISTANCE = 0.01, 5000, 2000.0, 3000.0


def usable_tiles(labels: DataFrame, tile: str = "tile", code: str = "code", least: int = LEAST_CELLS) -> DataFrame:
    """(tile, labelled, water): tiles (code 1 water, above 0 labelled) with enough of both classes and enough cells."""
    n, w = F.count_if(F.col(code) > 0), F.count_if(F.col(code) == 1)
    t = labels.groupBy(tile).agg(n.alias("labelled"), w.alias("water"))
    return t.where((F.col("water") >= LEAST_SHARE * F.col("labelled")) & (F.col("labelled") - F.col("water") >= LEAST_SHARE * F.col("labelled")) & (F.col("labelled") >= least))


def even_edges(cells: DataFrame, n_rows: int, n_cols: int, k: int = 2) -> DataFrame:
    """Cells that have a whole block of k x k."""
    return cells.where((F.col("row") < n_rows // k * k) & (F.col("col") < n_cols // k * k))


def mixed_blocks(cells: DataFrame, truth: str, estimates: list[str], k: int, keys: list[str]) -> DataFrame:
    """keys, row, col, truth share and mean estimates of k x k blocks that are labelled whole and hold both classes."""
    t = F.avg(F.col(truth).cast("double"))
    blocks = cells.groupBy(*keys, F.expr(f"row div {k}").alias("row"), F.expr(f"col div {k}").alias("col")).agg(F.count(truth).alias("_n"), t.alias("truth"), *[F.avg(F.col(e).cast("double")).alias(e) for e in estimates])
    return blocks.where((F.col("_n") == k * k) & (F.col("truth") > 0) & (F.col("truth") < 1)).drop("_n")


def support_errors(blocks: DataFrame, estimates: list[str], support: str = "support_m", tile: str = "tile") -> DataFrame:
    """A row for each support: blocks, tiles, and of each estimate its mean absolute error and its error of area in per cent."""
    n, total = F.count(F.lit(1)), F.sum("truth")
    error = [F.round(F.sum(F.abs(F.col(e) - F.col("truth"))) / n, 4).alias(f"{e}_mae") for e in estimates]
    area = [F.round(100 * (F.sum(e) - total) / total, 1).alias(f"{e}_area_error_pct") for e in estimates]
    return blocks.groupBy(support).agg(n.alias("mixed_blocks"), F.count_distinct(tile).alias("tiles"), *error, *area)


def pooled(tiles: DataFrame, counts: list[str]) -> DataFrame:
    """One row of scores from the sums of tp, fp, fn, tn over all tiles."""
    tp, fp, fn, tn = (F.sum(c) for c in counts)
    return tiles.agg(F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"), F.try_divide(tp, tp + fp + fn).alias("iou"), (tp + fp + fn + tn).alias("pixels"))


def valid_reaches(reaches: DataFrame, areas: DataFrame, rate: str = "rate", length: str = "length_m") -> DataFrame:
    """Reaches (rid, x, y) inside any box of areas (district, west, south, east, north), each once, that have a rate and are long enough."""
    inside = (F.col("x") >= F.col("west")) & (F.col("x") <= F.col("east")) & (F.col("y") >= F.col("south")) & (F.col("y") <= F.col("north"))
    # districts are few, and Spark broadcasts them only while they are small
    hit = reaches.where((F.col(rate) > 0) & (F.col(length) > LEAST_LENGTH)).join(areas, inside)
    one = hit.groupBy("rid").agg(F.min("district").alias("district"))
    return reaches.join(one, "rid")


def reach_rates(points: DataFrame, reaches: DataFrame, years: float, d: float = MOST_DISTANCE) -> DataFrame:
    """(rid, area_ha, rate): loss area (pid, px, py, area_m2) of the points nearest to each reach, and metres a year on both banks; 0 where there are none. A point equally near to two reaches counts for both."""
    sites = points.select(F.col("pid"), F.col("px").alias("x"), F.col("py").alias("y"), "area_m2")
    targets = reaches.select("rid", F.col("x").alias("px"), F.col("y").alias("py"))
    near = bounded_nearest(sites, targets, "pid", "rid", d).join(points.select("pid", "area_m2"), "pid")
    area = near.groupBy("rid").agg(F.sum("area_m2").alias("_a"))
    a = F.coalesce("_a", F.lit(0.0))
    return reaches.join(area, "rid", "left").select("rid", (a / 1e4).alias("area_ha"), (a / (2 * F.col("length_m")) / years).alias("mapped_rate"))
