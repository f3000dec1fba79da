"""Spherical geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The service area (inclusive, degrees) and the sphere radius in metres.
BOX_LAT = (4.45, 4.85)
BOX_LON = (-74.3, -73.9)
EARTH_RADIUS_M = 6378100.0

# Widens computed windows, in degrees, so that rounding never loses a point lying on the edge.
WINDOW_MARGIN = 1e-9

# Rounding error of a squared chord on the unit sphere.
CHORD_MARGIN = 1e-18


def in_box(lat: Column, lon: Column) -> Column:
    """Inside the service area; NaN is outside."""
    return lat.between(*BOX_LAT) & lon.between(*BOX_LON)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null when any coordinate is null."""
    dlat = F.sin(F.radians(lat2 - lat1) / 2)
    dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = dlat * dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon * dlon
    # not least(h, 1): least() skips nulls and would put unknown places half the globe away
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.when(h > 1, F.lit(1.0)).otherwise(h)))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on a sphere of radius one."""
    phi, theta = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)


def arc_m(chord2: Column) -> Column:
    """Great-circle metres between unit vectors whose straight distance, squared, is ``chord2``."""
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.sqrt(chord2) / 2, F.lit(1.0)))


def window_around(lat: float, lon: float, radius_m: float) -> tuple[tuple[float, float], tuple[float, float] | None]:
    """Latitude and longitude ranges holding every point within ``radius_m``.

    The longitude range is None when the circle holds a pole or crosses the date line; then only the
    latitude can be used to prune.
    """
    angle = radius_m / EARTH_RADIUS_M
    dlat = math.degrees(angle) + WINDOW_MARGIN
    lat_range = (lat - dlat, lat + dlat)
    if lat_range[0] <= -90 or lat_range[1] >= 90:
        return lat_range, None
    dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + WINDOW_MARGIN
    if lon - dlon < -180 or lon + dlon > 180:
        return lat_range, None
    return lat_range, (lon - dlon, lon + dlon)


def interpolate(start: Column, end: Column, fraction: Column) -> Column:
    return start + (end - start) * fraction


def coordinate(coordinates: Column, index: int) -> Column:
    """Element of a ``[lon, lat]`` array, null when the array is too short."""
    return F.get(coordinates, F.lit(index))


def geojson_point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def lat_lon(coordinates: Column) -> Column:
    """``[lon, lat]`` turned into ``[lat, lon]`` for map display."""
    return F.reverse(coordinates)


# Bits of a coordinate in a curve key; a cell is about two metres high.
CURVE_BITS = 23
# Steps that move the bits of a number apart: how far, and which bits are left in place.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread_bits(value: Column) -> Column:
    for step, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, step)).bitwiseAND(F.lit(mask))
    return value


def curve_key(lat: Column, lon: Column) -> Column:
    """Place on a space-filling curve: the bits of both coordinates by turns. Near keys are near places; null without a place."""
    cells = 1 << CURVE_BITS
    row, column = (
        F.least(F.greatest(F.floor((value + half) / (2 * half) * cells), F.lit(0)), F.lit(cells - 1)).cast("bigint")
        for value, half in ((lat, 90.0), (lon, 180.0))
    )
    return F.when(lat.isNotNull() & lon.isNotNull(), F.shiftleft(_spread_bits(row), 1).bitwiseOR(_spread_bits(column)))
