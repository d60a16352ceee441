"""Patches: connected cells of one class as rows, with areas, centroids, joint tests and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvia.functions.coordinates import from_utm
from fluvia.operators.regions import CELL, components, sieve, written
from fluvia.operators.stats import stouffer

#: Least lost land and greatest p of a patch, least change of a cell, deflation for neighbouring cells that share data.
LEAST_HA, PATCH_P, LEAST_CHANGE, DEFLATE = 0.02, 0.01, 0.10, 2.0


def labelled(cells: DataFrame, least: int = 1) -> DataFrame:
    """(row, col, cls, region) of the cells with a class above 0, after regions under ``least`` cells took their largest neighbour's class."""
    return components((sieve(cells, least) if least > 1 else cells.select(*CELL, "cls")).where("cls > 0"))


def polygons(cells: DataFrame, res: float, least: int = 1, x0: float = 0.0, y0: float = 0.0, means: dict[str, str] | None = None, greatest: dict[str, str] | None = None) -> DataFrame:
    """A row a patch: region, class, pixels, area, centroid (metres from the grid's corner, rows downwards), and means or greatest values of further columns of cells; missing values don't count."""
    means, greatest = means or {}, greatest or {}
    regions = labelled(cells, least)
    more = cells.select(*CELL, *dict.fromkeys([*means.values(), *greatest.values()]))
    x, y = x0 + (F.avg("col") + 0.5) * res, y0 - (F.avg("row") + 0.5) * res
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c))
    extra = [F.avg(known(c)).alias(k) for k, c in means.items()] + [F.max(known(c)).alias(k) for k, c in greatest.items()]
    return regions.join(more, CELL).groupBy("region").agg(F.first("cls").alias("cls"), F.count(F.lit(1)).alias("pixels"), (F.count(F.lit(1)) * (res * res / 1e4)).alias("area_ha"), x.alias("x"), y.alias("y"), *extra)


def located(patches: DataFrame, zone: int = 46) -> DataFrame:
    """Adds lat and lon of the centroids, six decimals."""
    lon, lat = from_utm(F.col("x"), F.col("y"), zone)
    return patches.withColumn("lat", F.round(lat, 6)).withColumn("lon", F.round(lon, 6))


def tested_patches(cells: DataFrame, pixel_ha: float, change: str = "d", p_up: str = "p_up", char: int = 5) -> DataFrame:
    """(region, cls, pixels, lost_ha, footprint_ha, mean_change, p, confidence) of cells (row, col, cls, change, p_up).

    Cells of classes 1 and ``char`` are one kind of patch, which is of ``char`` if more than half of its cells are.
    """
    kind = F.when(F.col("cls") == char, 1).otherwise(F.col("cls"))
    regions = written(components(cells.where("cls > 0").select(*CELL, kind.alias("cls"))))
    rows = regions.select(*CELL, "region").join(cells, CELL)
    sums = rows.groupBy("region").agg(F.count(F.lit(1)).alias("pixels"), F.abs(F.sum(change)).alias("_d"), F.count_if(F.col("cls") == char).alias("_char"), F.min("cls").alias("_cls"), F.max("cls").alias("_top"))
    tests = stouffer(rows, "region", p_up, DEFLATE).select("region", "p")
    cls = F.when(F.col("_char") > F.col("pixels") / 2, char).when(F.col("_top") == char, F.when(F.col("_char") == F.col("pixels"), char).otherwise(1)).otherwise(F.col("_cls"))
    lost, foot = F.col("_d") * pixel_ha, F.col("pixels") * pixel_ha
    return sums.join(tests, "region").select("region", cls.cast("int").alias("cls"), "pixels", lost.alias("lost_ha"), foot.alias("footprint_ha"), (lost / foot).alias("mean_change"), "p", (1 - F.col("p")).alias("confidence"))


def loss_patches(tested: DataFrame, pixel_ha: float, sign: int = 1) -> tuple[DataFrame, DataFrame]:
    """Cells (row, col, region) of patches of significant loss (sign 1) or gain (-1), and a row a patch: pixels, area_ha, p, kept."""
    d = F.col("d") * sign
    p = F.col("p_up") if sign > 0 else 1 - F.col("p_up")
    px = tested.where(F.col("rejected") & (d >= LEAST_CHANGE)).select(*CELL, d.alias("d"), p.alias("p"))
    cells = written(components(px.select(*CELL)).select(*CELL, "region"))
    rows = cells.join(px, CELL)
    sums = rows.groupBy("region").agg(F.count(F.lit(1)).alias("pixels"), (F.sum("d") * pixel_ha).alias("area_ha"))
    table = sums.join(stouffer(rows, "region", "p", DEFLATE).select("region", "p"), "region")
    return cells, table.withColumn("kept", (F.col("area_ha") >= LEAST_HA) & (F.col("p") < PATCH_P))


def kept_cells(cells: DataFrame, table: DataFrame) -> DataFrame:
    """Cells (row, col) of the patches that are kept."""
    return cells.join(table.where("kept"), "region", "left_semi").select(*CELL)


def baseline_test(loss: DataFrame, tests: DataFrame, pixel_ha: float, deflate: float = DEFLATE) -> DataFrame:
    """One row: patches of the baseline's loss, how many pass (joint p under ``PATCH_P`` and any cell significant), and their shares of patches and area."""
    regions = written(components(loss.select(*CELL)).select(*CELL, "region"))
    rows = regions.join(tests, CELL, "left").withColumn("p_up", F.coalesce("p_up", F.lit(0.5)))
    some = rows.groupBy("region").agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.bool_or("rejected"), F.lit(False)).alias("any"))
    passed = some.join(stouffer(rows, "region", "p_up", deflate).select("region", "p"), "region").withColumn("ok", (F.col("p") < PATCH_P) & F.col("any"))
    n, good = F.count(F.lit(1)), F.count_if("ok")
    area, fine = F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("ok"), F.col("k"))), F.lit(0))
    return passed.agg(n.alias("patches"), good.alias("significant"), F.round(F.try_divide(good, n), 3).alias("share_patches"), F.round(F.try_divide(fine, area), 3).alias("share_area"), F.round(area * pixel_ha, 1).alias("loss_ha"), F.round(fine * pixel_ha, 1).alias("loss_ha_significant"))


def binary_patches(cells: DataFrame, classes: tuple[int, ...], least: int, pixel_ha: float) -> DataFrame:
    """(region, pixels, area_ha) of the cells of some classes, taken as one, after the sieve."""
    mask = cells.select(*CELL, F.col("cls").isin(*classes).cast("int").alias("cls"))
    return labelled(mask, least).groupBy("region").agg(F.count(F.lit(1)).alias("pixels"), (F.count(F.lit(1)) * pixel_ha).alias("area_ha"))


def changed_area(cells: DataFrame, codes: DataFrame, pixel_ha: float, change: str = "d") -> DataFrame:
    """(code, label, ha): sums of the size of the change of each class, 0 where none has it."""
    sums = cells.groupBy(F.col("cls").alias("code")).agg((F.sum(F.abs(change)) * pixel_ha).alias("ha"))
    return codes.join(sums, "code", "left").select("code", "label", F.coalesce("ha", F.lit(0.0)).alias("ha"))


def agreement(first: DataFrame, second: DataFrame, steps: int = 2) -> DataFrame:
    """One row: intersection over union of two masks, and the share of each within ``steps`` dilations of the other."""
    from fluvia.operators.focal import dilate

    a, b = (written(m.select(*CELL).distinct()) for m in (first, second))
    both = a.withColumn("a", F.lit(True)).join(b.withColumn("b", F.lit(True)), CELL, "full")
    near_b, near_a = a.join(dilate(b, steps), CELL, "left_semi").agg(F.count(F.lit(1)).alias("n")), b.join(dilate(a, steps), CELL, "left_semi").agg(F.count(F.lit(1)).alias("m"))
    sums = both.agg(F.count_if(F.col("a") & F.col("b")).alias("i"), F.count(F.lit(1)).alias("u"), F.count("a").alias("na"), F.count("b").alias("nb"))
    joined = sums.crossJoin(F.broadcast(near_b)).crossJoin(F.broadcast(near_a))  # one row each
    return joined.select(F.round(F.try_divide("i", "u"), 3).alias("iou"), F.round(F.col("n") / F.greatest("na", F.lit(1)), 3).alias("first_near_second"), F.round(F.col("m") / F.greatest("nb", F.lit(1)), 3).alias("second_near_first"))
