"""Water maps with thresholds found from the data, change by water frequency, the river corridor, class codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvia.functions.special import label_confidence
from fluvia.functions.spectral import nearest_level
from fluvia.operators.composite import water_state
from fluvia.operators.focal import dilate
from fluvia.operators.regions import CELL, distance_to, inland_split, large_regions, sieve, written
from fluvia.operators.threshold import edge_otsu

#: First guesses and bounds of the thresholds, the confidence of a single composite, history codes by transition.
INDEX_GUESS, INDEX_BOUNDS, RADAR_GUESS, RADAR_BOUNDS = 0.0, (-0.3, 0.3), -16.0, (-22.0, -13.0)
COMPOSITE_CONFIDENCE = 0.6
HISTORY = {2: 1, 5: 2, 3: 3, 6: 4}
#: Edges of the classes of the detection limit in m2 of a cell.
LIMIT_EDGES = (15, 25, 40, 70)


def threshold_of(cells: DataFrame, value: str, first: float, above: bool, bounds: tuple[float, float], least: int) -> float:
    """One number: the band's Otsu threshold."""
    return float(edge_otsu(cells, value, first, above, bounds=bounds, least=least).first()[0])


def water_map(cells: DataFrame, levels: Sequence[float], radar_levels: Sequence[float] = (), share: float = 0.5, dates: int = 2, least: int = 2000, index_guess: float = INDEX_GUESS, index_bounds: tuple[float, float] = INDEX_BOUNDS, radar_guess: float = RADAR_GUESS, radar_bounds: tuple[float, float] = RADAR_BOUNDS) -> tuple[DataFrame, dict[str, float]]:
    """(row, col, water, tier, frequency, confidence), and the thresholds.

    cells: index (median), n, w_0.. (counts above each level), and, where there
    is radar, backscatter, rn, r_0.. The counts of the stored level nearest to the
    threshold are used; a single composite is judged by the threshold itself, the
    radar one at two decimals.
    """
    t = threshold_of(cells, "index", index_guess, True, index_bounds, least)
    used = nearest_level(levels, t)
    info = {"index": t, "index_used": used}
    k = F.col(f"w_{list(levels).index(used)}")
    none = F.lit(None)
    rk, rn, back, back_t = none.cast("long"), none.cast("long"), none.cast("double"), 0.0
    if radar_levels:
        r = threshold_of(cells, "backscatter", radar_guess, False, radar_bounds, least)
        info |= {"radar": r, "radar_used": nearest_level(radar_levels, r)}
        rk, rn, back, back_t = F.col(f"r_{list(radar_levels).index(info['radar_used'])}"), F.col("rn"), F.col("backscatter"), round(r, 2)
    s = water_state(k, F.col("n"), rk, rn, F.col("index"), t, back, back_t, dates, share)
    tier = F.col("s.tier")
    frequency = F.when(tier == "optical", k / F.col("n")).when(tier == "radar", rk / rn)
    confidence = F.when(tier == "optical", label_confidence(k, F.col("n"), share)).when(tier == "radar", label_confidence(rk, rn, share)).when(tier == "composite", COMPOSITE_CONFIDENCE)
    out = cells.withColumn("s", s).select(*CELL, F.coalesce("s.water", F.lit(False)).alias("water"), tier.alias("tier"), frequency.alias("frequency"), confidence.alias("confidence"))
    return out, info


def tier_shares(water: DataFrame) -> DataFrame:
    """One row: per cent of the known cells that each source told."""
    known = F.greatest(F.count("tier"), F.lit(1))
    return water.agg(*[F.round(100 * F.count_if(F.col("tier") == t) / known, 1).alias(f"{t}_pct") for t in ("optical", "radar", "composite")])


def frequency_state(k: Column, n: Column, index: Column, level: float, dates: int = 2, share: float = 0.5) -> dict[str, Column]:
    """Frequency with the composite where dates are too few, water, and the confidence at one half."""
    f = F.when(n >= dates, k / n).otherwise(F.coalesce(index > level, F.lit(False)).cast("double"))
    return {"frequency": f, "water": f >= share, "confidence": label_confidence(k, n, 0.5)}


def frequency_change(cells: DataFrame, least: int = 5, dates: int = 2, share: float = 0.5) -> DataFrame:
    """(row, col, loss, gain) of counts (ka, na, kb, nb): land that became water and the other way round, after the sieve of each."""
    was, now = F.try_divide("ka", "na") >= share, F.try_divide("kb", "nb") >= share
    ok = (F.col("na") >= dates) & (F.col("nb") >= dates)
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("int").alias("cls")
    x = written(cells.select(*CELL, yes(ok & ~was & now).alias("l"), yes(ok & was & ~now).alias("g")))
    loss, gain = (sieve(x.select(*CELL, F.col(c).alias("cls")), least).select(*CELL, (F.col("cls") == 1).alias(name)) for c, name in (("l", "loss"), ("g", "gain")))
    return loss.join(gain, CELL)


def corridor(ever: DataFrame, cells: DataFrame, res: float, least_cells: int, reach: float, inside: Column) -> DataFrame:
    """Cells within reach of large water bodies, inside the area."""
    near = distance_to(cells, large_regions(ever, least_cells), res)
    return cells.join(near, CELL).where((F.col("distance") <= reach) & inside).select(*CELL)


def pruned(cells: DataFrame, keep: DataFrame, block: int = 1024) -> DataFrame:
    """Cells of the blocks that any of keep's cells is in."""
    key = lambda df: df.withColumn("_br", F.expr(f"row div {block}")).withColumn("_bc", F.expr(f"col div {block}"))
    return key(cells).join(key(keep).select("_br", "_bc").distinct(), ["_br", "_bc"], "left_semi").drop("_br", "_bc")


def history_class(code: Column) -> Column:
    """Four classes of long transitions, else 0."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in HISTORY.items() for x in kv])[code], F.lit(0))


def ever_water(code: Column) -> Column:
    return F.coalesce(code.between(1, 10), F.lit(False))


def map_class(change: Column, was: Column, now: Column, inside: Column) -> Column:
    """Classes of the accuracy assessment: 10 land, 11 water, or the change; 0 outside."""
    stable = F.when(~was & ~now, 10).when(was & now, 11).otherwise(0)
    return F.when(~F.coalesce(inside, F.lit(False)), 0).when(change.isin(1, 2, 5, 6), change).otherwise(stable)


def hires_change(cells: DataFrame, river: DataFrame, touch: int = 4) -> DataFrame:
    """(row, col, cls) of cells (was, now, code, inside): loss 1 or, where water was before, 5; gain 2; inland patches 6."""
    c = F.when(~F.col("was") & F.col("now"), F.when(ever_water(F.col("code")), 5).otherwise(1)).when(F.col("was") & ~F.col("now"), 2).otherwise(0)
    return inland_split(cells.select(*CELL, F.when(F.col("inside"), c).otherwise(0).alias("cls")), river, touch)


def merged_class(standard: Column, corridor: Column, fine: Column, inside: Column) -> Column:
    """The tested classes of a cell's fine cells (an array) over the standard map; in the corridor the standard's water classes don't count. 1 wins over 5, 6 and 2."""
    base = F.when(corridor & standard.isin(1, 2, 5, 6), 0).otherwise(F.coalesce(standard, F.lit(0)))
    out = base
    for k in (2, 6, 5, 1):
        out = F.when(inside & F.coalesce(F.array_contains(fine, k), F.lit(False)), k).otherwise(out)
    return out


def detection_classes(limits: DataFrame, river: DataFrame, steps: int = 5) -> DataFrame:
    """(row, col, limit, cls): classes of the detection limit on the river's edge, else 0."""
    edge = dilate(river, steps).join(river, CELL, "left_anti").withColumn("_edge", F.lit(True))
    cls = F.lit(1)
    for e in LIMIT_EDGES:
        cls = cls + (F.col("limit") >= e).cast("int")
    return limits.join(edge, CELL, "left").select(*CELL, "limit", F.when(F.coalesce("_edge", F.lit(False)) & F.col("limit").isNotNull(), cls).otherwise(0).cast("int").alias("cls"))


def hard_water(cells: DataFrame, value: str = "index", least: int = 500) -> DataFrame:
    """Adds water: the index above its own threshold."""
    return cells.withColumn("water", F.col(value) > threshold_of(cells, value, INDEX_GUESS, True, INDEX_BOUNDS, least))
