"""Projections as column expressions, from published closed forms (Snyder, Map Projections, 1987).

Supported codes: 4326 (longitude, latitude), 3857 (spherical Mercator), 3395 (ellipsoidal Mercator), 6933
(cylindrical equal area, true at 30 degrees), polar stereographic 3413, 3995, 3031, 3976 and, by their scale at
the pole, 5041 and 5042 (32661 and 32761), and UTM 32601 to 32660 and 32701 to 32760 (Krueger's series to the
fourth power). Coordinates are always x, y. Others raise ``ValueError``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS 84: fixed values.
RADIUS, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)
#: Polar stereographic: latitude of true scale, or scale at the pole, its meridian, and false easting and northing; fixed values.
POLAR = {
    3413: (70.0, None, -45.0, 0.0), 3995: (71.0, None, 0.0, 0.0), 3031: (-71.0, None, 0.0, 0.0), 3976: (-70.0, None, 0.0, 0.0),
    5041: (90.0, 0.994, 0.0, 2e6), 5042: (-90.0, 0.994, 0.0, 2e6), 32661: (90.0, 0.994, 0.0, 2e6), 32761: (-90.0, 0.994, 0.0, 2e6),
}
UTM = (*range(32601, 32661), *range(32701, 32761))
CODES = (4326, 3857, 3395, 6933, *POLAR, *UTM)


def code(crs: int | str) -> int:
    """The EPSG code of 4326, "4326" or "EPSG:4326"."""
    m = re.fullmatch(r"(?:EPSG:)?(\d+)", str(crs), re.I)
    if not m or int(m[1]) not in CODES:
        raise ValueError(f"unknown or unsupported CRS: {crs!r}")
    return int(m[1])


def _ts(lat: Column) -> Column:
    """tan(pi/4 - lat/2) / ((1 - e sin lat) / (1 + e sin lat)) ** (e/2), for latitudes in radians."""
    es = F.sin(lat) * E
    return F.tan(F.lit(math.pi / 4) - lat / 2) / F.pow((1 - es) / (1 + es), F.lit(E / 2))


def _lat_of_ts(ts: Column) -> Column:
    """Inverse of ``_ts``."""
    return _lat_of_conformal(F.lit(math.pi / 2) - 2 * F.atan(ts))


def _lat_of_conformal(chi: Column) -> Column:
    """The series in the eccentricity, good to 1e-11 degrees."""
    e4, e6, e8 = E2**2, E2**3, E2**4
    terms = (E2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360, 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520, 7 * e6 / 120 + 81 * e8 / 1120, 4279 * e8 / 161280)
    out = chi
    for k, t in enumerate(terms, 1):
        out = out + t * F.sin(2 * k * chi)
    return out


def _q(sin: float | Column):
    log = math.log if isinstance(sin, float) else F.log
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - log((1 - E * sin) / (1 + E * sin)) / (2 * E))


_K0 = math.cos(math.radians(30)) / math.sqrt(1 - E2 * math.sin(math.radians(30)) ** 2)
_QP = _q(1.0 - 1e-16)


def _polar_scale(code_: int) -> float:
    """Distance from the pole for a ``_ts`` of 1."""
    lat, k0, *_ = POLAR[code_]
    if k0 is not None:
        return 2 * RADIUS * k0 / math.sqrt((1 + E) ** (1 + E) * (1 - E) ** (1 - E))
    lat = math.radians(abs(lat))
    es = E * math.sin(lat)
    m = math.cos(lat) / math.sqrt(1 - es * es)
    return RADIUS * m / (math.tan(math.pi / 4 - lat / 2) / ((1 - es) / (1 + es)) ** (E / 2))


_N = FLATTENING / (2 - FLATTENING)
#: Krueger's coefficients, there and back: fixed values.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_UTM_SCALE = 0.9996 * RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def _krueger(xi: Column, eta: Column, terms: tuple[float, ...], sign: int) -> tuple[Column, Column]:
    x, y = xi, eta
    for k, c in enumerate(terms, 1):
        x = x + sign * c * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        y = y + sign * c * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    return x, y


def _utm(code_: int) -> tuple[float, float]:
    """Meridian in radians and false northing."""
    return math.radians(code_ % 100 * 6 - 183), 1e7 if code_ > 32700 else 0.0


def from_lonlat(x: Column, y: Column, to: int) -> tuple[Column, Column]:
    lon, lat = F.radians(x), F.radians(y)
    if to == 4326:
        return x, y
    if to == 3857:
        return lon * RADIUS, F.log(F.tan(F.lit(math.pi / 4) + lat / 2)) * RADIUS
    if to == 3395:
        return lon * RADIUS, -F.log(_ts(lat)) * RADIUS
    if to == 6933:
        return lon * (RADIUS * _K0), _q(F.sin(lat)) * (RADIUS / (2 * _K0))
    if to in POLAR:
        true, _, meridian, false = POLAR[to]
        south = -1 if true < 0 else 1
        rho, turn = _ts(lat * south) * _polar_scale(to), lon - math.radians(meridian)
        return rho * F.sin(turn) + false, rho * F.cos(turn) * -south + false
    meridian, false = _utm(to)
    turn = lon - meridian
    t = F.sinh(F.atanh(F.sin(lat)) - E * F.atanh(E * F.sin(lat)))
    xi, eta = _krueger(F.atan2(t, F.cos(turn)), F.asinh(F.sin(turn) / F.hypot(t, F.cos(turn))), _ALPHA, 1)
    return eta * _UTM_SCALE + 500_000, xi * _UTM_SCALE + false


def to_lonlat(x: Column, y: Column, code_: int) -> tuple[Column, Column]:
    if code_ == 4326:
        return x, y
    if code_ == 3857:
        return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)
    if code_ == 3395:
        return F.degrees(x / RADIUS), F.degrees(_lat_of_ts(F.exp(-y / RADIUS)))
    if code_ == 6933:
        beta = F.asin(F.least(F.greatest(y * (2 * _K0 / (RADIUS * _QP)), F.lit(-1.0)), F.lit(1.0)))
        e4, e6 = E2**2, E2**3
        lat = beta + (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + (761 * e6 / 45360) * F.sin(6 * beta)
        return F.degrees(x / (RADIUS * _K0)), F.degrees(lat)
    if code_ in POLAR:
        true, _, meridian, false = POLAR[code_]
        south = -1 if true < 0 else 1
        x, y = x - false, y - false
        lon = F.degrees(F.atan2(x, y * -south)) + meridian
        return lon - 360 * F.floor((lon + 180) / 360), F.degrees(_lat_of_ts(F.hypot(x, y) / _polar_scale(code_))) * south
    meridian, false = _utm(code_)
    xi, eta = _krueger((y - false) / _UTM_SCALE, (x - 500_000) / _UTM_SCALE, _BETA, -1)
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi)) + meridian), F.degrees(_lat_of_conformal(F.asin(F.sin(xi) / F.cosh(eta))))


def reproject(x: Column, y: Column, source: int | str, target: int | str) -> tuple[Column, Column]:
    """Coordinates in another CRS; equal codes leave them as they are."""
    a, b = code(source), code(target)
    return (x, y) if a == b else from_lonlat(*to_lonlat(x, y, a), b)
