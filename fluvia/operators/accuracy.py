"""Design-based accuracy of maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, keys: list[str], predicted: str, truth: str) -> DataFrame:
    p, t = F.col(predicted), F.col(truth)
    c = rows.groupBy(*keys) if keys else rows.groupBy()
    out = c.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return (
        out.withColumn("accuracy", F.try_divide(tp + tn, tp + fp + fn + tn)).withColumn("f1", F.try_divide(2 * tp, 2 * tp + fp + fn))
        .withColumn("iou", F.try_divide(tp, tp + fp + fn)).withColumn("users", F.try_divide(tp, tp + fp)).withColumn("producers", F.try_divide(tp, tp + fn))
    )


def stratified_mean(sample: DataFrame, strata: DataFrame, stratum: str, value: Column) -> DataFrame:
    """One row (mean, se): weights are shares of the strata's sizes (stratum, size); a stratum of one label adds no variance."""
    total = strata.agg(F.sum("size").alias("total"))
    per = sample.withColumn("_v", value).groupBy(stratum).agg(F.avg("_v").alias("m"), F.coalesce(F.var_samp("_v"), F.lit(0.0)).alias("s2"), F.count("_v").alias("n"))
    w = F.col("size") / F.col("total")
    return per.join(strata, stratum).crossJoin(F.broadcast(total)).agg(F.sum(w * F.col("m")).alias("mean"), F.sqrt(F.sum(w * w * F.col("s2") / F.col("n"))).alias("se"))


def ratio(sample: DataFrame, strata: DataFrame, stratum: str, y: Column, x: Column) -> DataFrame:
    """One row (ratio, se) of totals y / x; NULL where x is 0."""
    total = strata.agg(F.sum("size").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    per = sample.withColumn("_y", y).withColumn("_x", x).groupBy(stratum).agg(
        F.avg("_y").alias("my"), F.avg("_x").alias("mx"), zero(F.var_samp("_y")).alias("vy"), zero(F.var_samp("_x")).alias("vx"), zero(F.covar_samp("_x", "_y")).alias("vxy"), F.count("_y").alias("n")
    )
    w = F.col("size") / F.col("total")
    joined = per.join(strata, stratum).crossJoin(F.broadcast(total)).withColumn("w", w)
    sums = joined.agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in ("my", "mx")], *[F.sum(F.col("w") * F.col("w") * F.col(c) / F.col("n")).alias(c) for c in ("vy", "vx", "vxy")])
    r = F.try_divide(F.col("my"), F.col("mx"))
    return sums.select(r.alias("ratio"), (F.sqrt(F.greatest(F.col("vy") + r * r * F.col("vx") - 2 * r * F.col("vxy"), F.lit(0.0))) / F.col("mx")).alias("se"))


def area_matrix(sample: DataFrame, strata: DataFrame, stratum: str, map_class: str, reference: str) -> DataFrame:
    """(map class, reference, share): estimated shares of area."""
    total = strata.agg(F.sum("size").alias("total"))
    n = sample.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    cells = sample.groupBy(stratum, map_class, reference).agg(F.count(F.lit(1)).alias("k"))
    joined = cells.join(n, stratum).join(strata, stratum).crossJoin(F.broadcast(total))
    return joined.groupBy(map_class, reference).agg(F.sum(F.col("size") / F.col("total") * F.col("k") / F.col("n")).alias("share"))
