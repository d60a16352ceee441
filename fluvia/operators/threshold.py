"""Histogram thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.operators.focal import dilate, erode
from fluvia.operators.regions import written
from fluvia.operators.stats import quantiles

BINS = 256


def histogram(values: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """(bin, n, low, high) of equal widths between the least and the greatest value; the last bin is closed."""
    ends = values.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    at = F.least(F.floor((F.col(value) - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
    return values.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy("low", "high", at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def otsu(values: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """One row (threshold): the middle of the plateau of greatest between-class variance; over ``bins`` rows only."""
    h = histogram(values, value, bins)
    ends = h.select("low", "high").distinct()
    every = values.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(ends)).join(F.broadcast(h.select("bin", "n")), "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("double"))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    centre = F.col("low") + (F.col("bin") + 0.5) * (F.col("high") - F.col("low")) / bins
    c = every.withColumn("centre", centre).withColumn("w0", F.sum("n").over(w)).withColumn("s0", F.sum(F.col("n") * F.col("centre")).over(w))
    c = c.withColumn("w1", F.sum("n").over(whole) - F.col("w0")).withColumn("s1", F.sum(F.col("n") * F.col("centre")).over(whole) - F.col("s0"))
    gap = F.col("s0") / F.greatest("w0", F.lit(1.0)) - F.col("s1") / F.greatest("w1", F.lit(1.0))
    c = c.where(F.col("bin") < bins - 1).withColumn("between", F.col("w0") * F.col("w1") * gap * gap)
    top = c.agg(F.max("between").alias("top"))
    plateau = c.crossJoin(F.broadcast(top)).where(F.col("between") >= F.col("top") * (1 - 1e-6)).agg(F.bround(F.avg("bin")).cast("int").alias("at"), F.first("low").alias("low"), F.first("high").alias("high"))
    return plateau.select((F.col("low") + (F.col("at") + 0.5) * (F.col("high") - F.col("low")) / bins).alias("threshold"))


def edge_otsu(cells: DataFrame, value: str, first: float, above: bool = True, band: int = 3, bounds: tuple[float, float] | None = None, least: int = 2000) -> DataFrame:
    """One row (threshold): Otsu over the band around the first guess's edge, clipped to its percentiles 1-99; the first guess where the band has too few cells."""
    fits = (F.col(value) > first) if above else (F.col(value) < first)
    water = cells.where(fits).select("row", "col")
    zone = dilate(water, band).join(erode(water, band), ["row", "col"], "left_anti")
    inside = cells.where(F.col(value).isNotNull()).join(zone, ["row", "col"], "left_semi")
    inside = written(inside.select(F.col(value).alias("v")))
    n = inside.count()
    if n < least:
        return cells.sparkSession.range(1).select(F.lit(float(first)).alias("threshold"))
    p1, p99 = quantiles(inside, "v", (0.01, 0.99))
    held = inside.select(F.least(F.greatest(F.col("v"), F.lit(p1)), F.lit(p99)).alias("v"))
    t: Column = F.col("threshold")
    if bounds:
        t = F.least(F.greatest(t, F.lit(float(bounds[0]))), F.lit(float(bounds[1])))
    return otsu(held, "v").select(F.when(F.col("threshold").isNotNull(), t).otherwise(F.lit(float(first))).alias("threshold"))
