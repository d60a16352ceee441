"""Observations to composites: scene choice, mosaics, medians, counts, water state, change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["row", "col"]


def clearest(scenes: DataFrame, k: int, tile: str, cloud: str, ties: Sequence[str]) -> DataFrame:
    """The k least cloudy scenes of each tile. No tile is the tile "all", no cloud value counts as 100."""
    w = Window.partitionBy(F.coalesce(F.col(tile).cast("string"), F.lit("all"))).orderBy(F.coalesce(F.col(cloud), F.lit(100.0)), *ties)
    return scenes.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def mosaic(obs: DataFrame, bands: Sequence[str], day: str = "date") -> DataFrame:
    """One row a cell and day; overlapping tiles of a day give their least value, whatever the order of rows."""
    return obs.groupBy(*CELL, day).agg(*[F.min(b).alias(b) for b in bands])


def highest(tiles: DataFrame, bands: Sequence[str]) -> DataFrame:
    """The greatest value of overlapping tiles in each cell."""
    return tiles.groupBy(*CELL).agg(*[F.max(b).alias(b) for b in bands])


def median_composite(obs: DataFrame, bands: Sequence[str]) -> DataFrame:
    return obs.groupBy(*CELL).agg(*[F.median(b).alias(b) for b in bands])


def threshold_counts(obs: DataFrame, index: str, levels: Sequence[float], clear: Column, above: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Clear dates of each cell, and at how many the index is beyond each level: one pass for all levels."""
    test = lambda t: (F.col(index) > t) if above else (F.col(index) < t)
    ok = F.coalesce(clear & F.col(index).isNotNull(), F.lit(False))
    return obs.groupBy(*CELL, *keys).agg(F.count_if(ok).alias("n"), *[F.count_if(ok & test(t)).alias(f"w_{i}") for i, t in enumerate(levels)])


def latest_baseline(scenes: DataFrame, keys: Sequence[str], baseline: str) -> DataFrame:
    """One scene a key: that of the latest processing baseline."""
    rest = [c for c in scenes.columns if c not in keys]
    return scenes.groupBy(*keys).agg(F.max(F.struct(baseline, *[c for c in rest if c != baseline])).alias("s")).select(*keys, "s.*")


def water_state(k: Column, n: Column, radar_k: Column, radar_n: Column, index: Column, index_level: float, backscatter: Column, backscatter_level: float, least: int = 2, share: float = 0.5) -> Column:
    """Water by optical frequency, else radar frequency, else one composite: struct(water, tier)."""
    by = lambda water, tier: F.struct(water.alias("water"), F.lit(tier).alias("tier"))
    return (
        F.when(n >= least, by(k / n >= share, "optical"))
        .when(radar_n >= least, by(radar_k / radar_n >= share, "radar"))
        .when(index.isNotNull(), by(index > index_level, "composite"))
        .when(backscatter.isNotNull(), by(backscatter < backscatter_level, "composite"))
    )


def change_class(was: Column, now: Column, ndvi_change: Column, bare_was: Column, bare_now: Column, was_channel: Column) -> Column:
    """5 or 1 land to water (5 where water was before), 2 water to land, 3 vegetation loss, 4 new bare soil, else 0."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(~was & now), F.when(yes(was_channel), 5).otherwise(1))
        .when(yes(was & ~now), 2)
        .when(yes(~was & ~now & (ndvi_change < -0.15)), 3)
        .when(yes(~now & (bare_now > 0.05) & (bare_was <= 0.05)), 4)
        .otherwise(0)
    )


def class_areas(cells: DataFrame, cls: str, codes: DataFrame, pixel_ha: float) -> DataFrame:
    """(code, label, pixels, ha) of every code, 0 where no cell has it."""
    n = cells.groupBy(F.col(cls).alias("code")).agg(F.count(F.lit(1)).alias("pixels"))
    return codes.join(n, "code", "left").select("code", "label", F.coalesce("pixels", F.lit(0)).alias("pixels"), (F.coalesce("pixels", F.lit(0)) * pixel_ha).alias("ha"))


def block_mean(cells: DataFrame, value: str, k: int = 2, whole: bool = True) -> DataFrame:
    """Means of k x k blocks. whole: a block that lacks a value has none."""
    mean = F.avg(value)
    if whole:
        mean = F.when(F.count(value) == k * k, mean)
    return cells.groupBy(F.expr(f"row div {k}").alias("row"), F.expr(f"col div {k}").alias("col")).agg(mean.alias(value))


def subset_statistics(obs: DataFrame, value: str, day: str = "date") -> DataFrame:
    """(row, col, subset, n, mean, var) of all, odd and even dates. A date's parity is that of its place among all dates of the cube."""
    days = obs.select(day).distinct()
    # dates are few whatever the number of cells is
    numbered = days.withColumn("place", F.dense_rank().over(Window.orderBy(day)))
    parity = F.when(F.col("place") % 2 == 1, "odd").otherwise("even")
    rows = obs.join(numbered, day).withColumn("subset", F.explode(F.array(F.lit("all"), parity)))
    return rows.groupBy(*CELL, "subset").agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))


def composite_water(index: Column, index_level: float, backscatter: Column, backscatter_level: float) -> Column:
    """Water of a single composite; radar only where there is no index."""
    return F.coalesce(F.when(index.isNotNull(), index > index_level).otherwise(backscatter < backscatter_level), F.lit(False))


def shown(value: Column, low: float, high: float, log: bool = False) -> Column:
    """A value for display from 0 to 1: clipped to its range, on a logarithmic scale where asked for."""
    from fluvia.functions.spectral import clip

    f = (lambda x: F.log10(F.greatest(x, F.lit(1e-6)))) if log else (lambda x: x)
    lo, hi = f(F.lit(float(low))), f(F.lit(float(high)))
    return clip((f(clip(value, float(low), float(high))) - lo) / (hi - lo), 0.0, 1.0)


def merged_confidence(cls: Column, corridor: Column, tested: Column, standard: Column) -> Column:
    """The confidence of a change: the test's in the corridor, the standard one outside; NULL without a water change."""
    return F.when(cls.isin(1, 2, 5, 6), F.when(corridor, tested).otherwise(standard))
