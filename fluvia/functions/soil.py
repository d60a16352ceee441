"""Soil-loss factors (RUSLE). Inputs are columns; NULL gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fluvia.functions.spectral import clip

#: Fixed values of the equations.
LENGTH_CAP, UNIT_PLOT = 150.0, 22.13
RISK_EDGES = (5.0, 10.0, 20.0, 40.0)


def ls_factor(slope_deg: Column, res: float, cap: float = LENGTH_CAP) -> Column:
    s = F.sin(F.radians(slope_deg))
    steep = F.when(F.tan(F.radians(slope_deg)) < 0.09, 10.8 * s + 0.03).otherwise(16.8 * s - 0.5)
    beta = (s / 0.0896) / (3.0 * F.pow(s, F.lit(0.8)) + 0.56)
    return F.greatest(F.pow(F.lit(min(res, cap) / UNIT_PLOT), beta / (1 + beta)) * steep, F.lit(0.0))


def c_factor(ndvi: Column, alpha: float = 2.0, beta: float = 1.0) -> Column:
    n = clip(ndvi, -0.99, 0.99)
    return clip(F.exp(-alpha * n / (beta - n)), 0.0, 1.0)


def r_factor(rain_mm: Column) -> Column:
    return 79 + 0.363 * rain_mm


def k_factor(sand: Column, silt: Column, clay: Column, carbon: Column) -> Column:
    """Williams' texture equation in SI units; percentages."""
    sn = 1.0 - sand / 100.0
    coarse = 0.2 + 0.3 * F.exp(-0.256 * sand * (1.0 - silt / 100.0))
    fine = F.pow(silt / F.greatest(clay + silt, F.lit(1e-6)), F.lit(0.3))
    organic = 1.0 - 0.25 * carbon / (carbon + F.exp(3.72 - 2.95 * carbon))
    sandy = 1.0 - 0.7 * sn / (sn + F.exp(-5.51 + 22.9 * sn))
    return coarse * fine * organic * sandy * 0.1317


def soil_loss(r: Column, k: Column, ls: Column, c: Column, water: Column, p: float = 1.0) -> Column:
    return F.when(~water, r * k * ls * c * p)
