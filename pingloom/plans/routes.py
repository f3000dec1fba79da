"""Route geometry: segments between stops, points along them, drawable lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingloom.functions import geo, labels
from pingloom.operators import ordered

MIN_STOPS = 2
# Edges per drawn piece; a longer route comes as several pieces.
PIECE_EDGES = 1000


def usable_routes(stops: DataFrame, route: str = "ruta_id") -> DataFrame:
    """Routes with at least two stops, with their number of stops and of segments."""
    return (
        stops.groupBy(route)
        .agg(F.count("*").alias("paradas"))
        .filter(F.col("paradas") >= MIN_STOPS)
        .select(route, "paradas", (F.col("paradas") - 1).alias("tramos"))
    )


def _official(stops: DataFrame) -> DataFrame:
    return stops.filter("parada").drop("parada") if "parada" in stops.columns else stops


def segments(
    stops: DataFrame,
    route: str = "ruta_id",
    order: tuple[str, ...] = ("orden", "estacion_id"),
) -> DataFrame:
    """Consecutive stop pairs of each route: n stops give n-1 segments, one stop gives none.

    ``stops`` has the route, ``orden``, ``estacion_id, nombre, lat, lon``; a stop without ``orden`` comes last. If it has
    ``parada``, only the official stops of a route count.
    """
    paired = ordered.with_next(
        _official(stops), [route], list(order), ["estacion_id", "nombre", "lat", "lon"]
    ).filter(F.col("_next").isNotNull())
    return paired.select(
        *[c for c in stops.columns if c not in ("estacion_id", "nombre", "lat", "lon", "parada")],
        F.col("estacion_id").alias("inicio_id"),
        F.col("_next.estacion_id").alias("fin_id"),
        F.col("nombre").alias("inicio"),
        F.col("_next.nombre").alias("fin"),
        labels.segment_label(F.col("nombre"), F.col("_next.nombre")).alias("tramo"),
        F.col("lat").alias("lat_a"),
        F.col("lon").alias("lon_a"),
        F.col("_next.lat").alias("lat_b"),
        F.col("_next.lon").alias("lon_b"),
    )


def along(segment_rows: DataFrame, fraction: Column) -> DataFrame:
    """Add the point at ``fraction`` of every segment."""
    return segment_rows.select(
        "*",
        geo.interpolate(F.col("lat_a"), F.col("lat_b"), fraction).alias("lat"),
        geo.interpolate(F.col("lon_a"), F.col("lon_b"), fraction).alias("lon"),
    )


def route_lines(
    stops: DataFrame,
    route: str = "ruta_id",
    order: tuple[str, ...] = ("orden", "estacion_id"),
    piece_edges: int = PIECE_EDGES,
) -> DataFrame:
    """Ordered ``[{lat, lon}]`` arrays to draw each route with, cut into pieces of bounded length.

    A piece ends with the point the next one begins with, so n points in any number of pieces have n-1 edges. Only
    official stops count where ``stops`` has ``parada``.
    """
    placed = ordered.with_position(_official(stops), [route], list(order))
    point = F.struct("_pos", F.col("lat").alias("lat"), F.col("lon").alias("lon"))
    piece = F.floor(F.col("_pos") / piece_edges).cast("int")
    at_border = (F.col("_pos") % piece_edges == 0) & (F.col("_pos") > 0)
    both = F.when(at_border, F.array(piece - 1, piece)).otherwise(F.array(piece))
    lines = (
        placed.withColumn("pieza", F.explode(both))
        .groupBy(route, "pieza")
        .agg(F.sort_array(F.collect_list(point)).alias("_line"))
        .select(
            route,
            "pieza",
            F.size("_line").alias("puntos"),
            F.transform("_line", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("linea"),
        )
    )
    # the last point of a route may begin a piece of its own, which would have no edge
    return lines.filter((F.col("puntos") > 1) | (F.col("pieza") == 0))
