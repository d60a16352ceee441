"""Reflectance, indices and class edges. NaN is made NULL at every boundary; NULL never satisfies a test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Clear scene classes, and the offset of processing baselines from 04.00 on.
CLEAR_CLASSES = (4, 5, 6, 7)
OFFSET, OFFSET_FROM = -1000, "04.00"


def known(x: Column) -> Column:
    """NaN as NULL."""
    return F.when(~F.isnan(x), x)


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def baseline_offset(baseline: Column) -> Column:
    return F.when(baseline >= OFFSET_FROM, OFFSET).otherwise(0)


def reflectance(dn: Column, scene_class: Column, baseline: Column) -> Column:
    """Scaled to 0..1; NULL where it isn't clear or has no signal."""
    clear = scene_class.isin(*CLEAR_CLASSES) & (dn > 0)
    return F.when(clear, clip((dn + baseline_offset(baseline)) / 10000.0, 0.0, 1.0))


def normalized_difference(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def indices(b02: Column, b03: Column, b04: Column, b08: Column, b11: Column) -> dict[str, Column]:
    return {"ndvi": normalized_difference(b08, b04), "mndwi": normalized_difference(b03, b11), "bsi": normalized_difference(b11 + b04, b08 + b02)}


def classify(x: Column, edges: Sequence[float]) -> Column:
    """1 up to the first edge, then one more for each edge that x is above; bins are (low, high]."""
    c = F.lit(len(edges) + 1)
    for k, e in reversed(list(enumerate(edges))):
        c = F.when(x <= e, k + 1).otherwise(c)
    return F.when(x.isNotNull(), c).cast("int")


def decibels(linear: Column) -> Column:
    return F.when(linear > 0, 10 * F.log10(linear))


def nearest_level(levels: Sequence[float], t: float) -> float:
    """The stored threshold nearest to t, the first of equals."""
    return min(levels, key=lambda v: abs(v - t))
