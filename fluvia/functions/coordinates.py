"""Geographic and projected coordinates as column expressions (Krueger series, 6th order in n is not needed: 4th gives under a millimetre)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_K0, _E0 = 0.9996, 500000.0
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def to_utm(lon: Column, lat: Column, zone: int = 46) -> tuple[Column, Column]:
    """Easting and northing on the northern half."""
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    atanh = lambda x: 0.5 * F.log((1 + x) / (1 - x))
    t = F.sinh(atanh(s) - _ECC * atanh(_ECC * s))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _E0 + _K0 * _R * x, _K0 * _R * y


def from_utm(x: Column, y: Column, zone: int = 46) -> tuple[Column, Column]:
    """Longitude and latitude."""
    xi, eta = y / (_K0 * _R), (x - _E0) / (_K0 * _R)
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(v), F.cos(u))) + (zone * 6 - 183), F.degrees(phi)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return _A * F.radians(lon), _A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))
