"""Coordinates: metric Lambert conic positions to degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.scalars import decimal_comma

# Ellipsoid and the two-parallel conic of the French national grid.
MAJOR_AXIS = 6378137.0
FLATTENING = 1 / 298.257222101
PARALLELS = (44.0, 49.0)
ORIGIN = (46.5, 3.0)
FALSE_EASTING, FALSE_NORTHING = 700000.0, 6600000.0

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)


def _parallel_radius(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - _E2 * math.sin(lat) ** 2)


def _isometric(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


def cone() -> tuple[float, float, float]:
    """Cone constant, scale and the radius of the origin parallel."""
    p1, p2 = (math.radians(p) for p in PARALLELS)
    n = math.log(_parallel_radius(p1) / _parallel_radius(p2)) / math.log(_isometric(p1) / _isometric(p2))
    scale = MAJOR_AXIS * _parallel_radius(p1) / (n * _isometric(p1) ** n)
    return n, scale, scale * _isometric(math.radians(ORIGIN[0])) ** n


def latitude_series() -> list[float]:
    """Factors of sin(2x), sin(4x), sin(6x), sin(8x) from conformal to geodetic latitude."""
    e2, e4, e6, e8 = _E2, _E2**2, _E2**3, _E2**4
    return [
        e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360,
        7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520,
        7 * e6 / 120 + 81 * e8 / 1120,
        4279 * e8 / 161280,
    ]


def conic_to_degrees(easting: Column, northing: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees, closed form, no iteration."""
    n, scale, origin_radius = cone()
    x = easting - F.lit(FALSE_EASTING)
    y = F.lit(origin_radius) - (northing - F.lit(FALSE_NORTHING))
    radius = F.sqrt(x * x + y * y)
    conformal = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(F.pow(radius / F.lit(scale), F.lit(1 / n)))
    lat = conformal
    for k, factor in enumerate(latitude_series(), start=1):
        lat = lat + F.lit(factor) * F.sin(conformal * F.lit(2.0 * k))
    lon = F.atan2(x, y) / F.lit(n) + F.lit(math.radians(ORIGIN[1]))
    return F.degrees(lat), F.degrees(lon)


def round6(value: Column) -> Column:
    return F.round(value.cast("decimal(38,12)"), 6).cast("double")


def degrees_pair(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Normalised (lat, lon) of raw text: metric pairs converted, degrees passed on.

    A pair with one unreadable side is dropped as a whole.
    """
    raw_lat, raw_lon = decimal_comma(lat), decimal_comma(lon)
    metric_lat, metric_lon = conic_to_degrees(raw_lon, raw_lat)
    projected = F.abs(raw_lat) > 90
    both = raw_lat.isNotNull() & raw_lon.isNotNull()
    return (
        F.when(both, round6(F.when(projected, metric_lat).otherwise(raw_lat))),
        F.when(both, round6(F.when(projected, metric_lon).otherwise(raw_lon))),
    )
