"""Distance filters and distance joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingloom.functions import geo


def near_point(positions: DataFrame, lat: float, lon: float, max_m: float, tie: str = "bus_id") -> DataFrame:
    """Rows within ``max_m`` metres (inclusive), nearest first, with ``distancia_m``.

    The coordinate ranges are plain comparisons on columns, so they reach the Parquet statistics when
    ``positions`` is a stored table; the exact distance decides on what is left.
    """
    lat_range, lon_range = geo.window_around(lat, lon, max_m)
    rough = F.col("lat").between(*lat_range)
    if lon_range is not None:
        rough = rough & F.col("lon").between(*lon_range)
    distance = geo.haversine_m(F.col("lat"), F.col("lon"), F.lit(float(lat)), F.lit(float(lon)))
    return (
        positions.filter(rough)
        .withColumn("distancia_m", distance)
        .filter(F.col("distancia_m") <= float(max_m))
        .orderBy("distancia_m", tie)
    )


class Grid:
    """Cells that are at least one radius wide: bands of latitude, each cut evenly around the globe.

    A band holds fewer cells the nearer it is to a pole, and cell numbers wrap at the date line, so
    covering a circle with cells is exact everywhere.
    """

    def __init__(self, radius_m: float):
        if radius_m <= 0:
            raise ValueError("radius must be positive")
        self.angle = min(radius_m / geo.EARTH_RADIUS_M, math.pi)
        self.band_deg = math.degrees(self.angle) + geo.WINDOW_MARGIN

    def _band(self, lat: Column) -> Column:
        return F.floor(lat / self.band_deg)

    def _cells_in_band(self, band: Column) -> Column:
        """As many cells as fit at the band's edge nearer to a pole, where a radius spans most degrees."""
        edge = F.greatest(F.abs(band * self.band_deg), F.abs((band + 1) * self.band_deg))
        return F.greatest(F.floor(F.cos(F.radians(edge)) * (360 / self.band_deg)), F.lit(1).cast("bigint"))

    def _column(self, band: Column, lon: Column) -> Column:
        return F.floor((lon + 180) / 360 * self._cells_in_band(band))

    def _number(self, band: Column, slot: Column) -> Column:
        """Band and slot as one bigint, which Spark joins faster than a pair."""
        return F.shiftleft(band, 32) + F.pmod(slot, self._cells_in_band(band))

    def cell(self, lat: Column, lon: Column) -> Column:
        """The cell of a point."""
        band = self._band(lat)
        return self._number(band, self._column(band, lon))

    def cover(self, lat: Column, lon: Column) -> Column:
        """Array of all cells touched by the circle around a point, each once."""
        dlat = F.lit(self.band_deg)
        sine = F.lit(math.sin(min(self.angle, math.pi / 2))) / F.cos(F.radians(lat))
        pole_free = (F.abs(lat) + dlat < 90) & (sine < 1)
        # the widest longitude difference within the circle
        dlon = F.when(pole_free, F.degrees(F.asin(sine)) + geo.WINDOW_MARGIN).otherwise(180.0)

        def in_band(band: Column) -> Column:
            slots = F.sequence(self._column(band, lon - dlon), self._column(band, lon + dlon))
            return F.transform(slots, lambda slot: self._number(band, slot))

        bands = F.sequence(self._band(lat - dlat), self._band(lat + dlat))
        return F.array_distinct(F.flatten(F.transform(bands, in_band)))


def near_join(positions: DataFrame, stations: DataFrame, radius_m: float) -> DataFrame:
    """All (position, station) pairs within ``radius_m``; ``stations`` has ``id, lat, lon``.

    Returns the position columns plus ``estacion_id`` and ``distancia_m``. An equi-join on grid cells:
    every position has one cell, every station all cells its circle touches, so no pair is met twice.
    """
    grid = Grid(radius_m)
    lat, lon = F.col("lat").cast("double"), F.col("lon").cast("double")
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    cells = stations.filter(known).select(
        F.col("id").alias("estacion_id"),
        *[axis.alias(f"_s{i}") for i, axis in enumerate(geo.unit_vector(lat, lon))],
        F.explode(grid.cover(lat, lon)).alias("_cell"),
    )
    located = positions.filter(known).select(
        *positions.columns,
        *[axis.alias(f"_p{i}") for i, axis in enumerate(geo.unit_vector(lat, lon))],
        grid.cell(lat, lon).alias("_cell"),
    )

    # Spark broadcasts the stations where their size allows it, and splits crowded cells at run time where not
    pairs = located.join(cells, "_cell")

    # Trigonometry is done once per position and station. A pair takes three subtractions to rule out,
    # and an arc sine only if it is near. Comparing chords is comparing arcs: one grows with the other.
    apart = [F.col(f"_p{i}") - F.col(f"_s{i}") for i in range(3)]
    chord2 = apart[0] * apart[0] + apart[1] * apart[1] + apart[2] * apart[2]
    limit2 = (2 * math.sin(grid.angle / 2)) ** 2
    return (
        pairs.withColumn("_chord2", chord2)
        .filter(F.col("_chord2") <= limit2 + geo.CHORD_MARGIN)
        .select(*positions.columns, "estacion_id", geo.arc_m(F.col("_chord2")).alias("distancia_m"))
    )
