"""Reports over the relational tables.

No join is forced to broadcast: Spark checks the size of a side itself, and splits skewed partitions
at run time where both sides have to be shuffled. Counts are taken on the foreign key before
joining, so a type or route that owns a third of all rows reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingloom.sources.network_tables import Network


def _asc(*names: str) -> list[Column]:
    return [F.asc_nulls_last(n) for n in names]


def _buses(net: Network, routes: DataFrame) -> DataFrame:
    route = routes.select(
        F.col("id").alias("ruta_id"), F.col("codigo").alias("ruta_codigo"), F.col("nombre").alias("ruta_nombre")
    )
    kind = net.tipo_bus.select(F.col("id").alias("tipo_bus_id"), F.col("nombre").alias("tipo_bus"))
    vehicle = net.bus.select(
        "ruta_id", "tipo_bus_id", F.col("id").alias("bus_id"), "placa", "modelo",
        F.col("estado").alias("estado_bus"), "fecha_asignacion",
    )
    return vehicle.join(route, "ruta_id").join(kind, "tipo_bus_id").select(
        "ruta_codigo", "ruta_nombre", "bus_id", "placa", "modelo", "tipo_bus", "estado_bus", "fecha_asignacion"
    )


def buses_by_route(net: Network) -> DataFrame:
    return _buses(net, net.ruta).orderBy(*_asc("ruta_codigo", "placa"), "bus_id")


def buses_of_route(net: Network, codigo: str) -> DataFrame:
    return _buses(net, net.ruta.filter(F.col("codigo") == codigo)).orderBy(*_asc("placa"), "bus_id")


def route_stops(net: Network, codigo: str | None = None, official_only: bool = False) -> DataFrame:
    """Stops joined with their route and station, every column of the three that reports use."""
    routes = net.ruta if codigo is None else net.ruta.filter(F.col("codigo") == codigo)
    route = routes.select(
        F.col("id").alias("ruta_id"), F.col("codigo").alias("ruta_codigo"), F.col("nombre").alias("ruta_nombre")
    )
    station = net.estacion.select(
        F.col("id").alias("estacion_id"),
        F.col("nombre").alias("estacion_nombre"),
        F.col("tipo").alias("tipo_estacion"),
        F.col("estado").alias("estado_estacion"),
        "latitud",
        "longitud",
        "direccion",
    )
    stops = net.estacion_por_ruta.filter("parada") if official_only else net.estacion_por_ruta
    return stops.join(route, "ruta_id").join(station, "estacion_id")


def _in_route_order(stops: DataFrame) -> DataFrame:
    return stops.orderBy(*_asc("ruta_codigo", "orden"), "estacion_id")


def stations_by_route(net: Network) -> DataFrame:
    return _in_route_order(route_stops(net)).select(
        "ruta_codigo", "ruta_nombre", "estacion_id", "estacion_nombre", "tipo_estacion", "estado_estacion",
        "latitud", "longitud", "direccion", "orden", "parada", "fecha_creacion",
    )


def official_stops(net: Network) -> DataFrame:
    return _in_route_order(route_stops(net, official_only=True)).select(
        "ruta_codigo", "ruta_nombre", "estacion_id", "estacion_nombre", "orden", "parada"
    )


def official_stops_of_route(net: Network, codigo: str) -> DataFrame:
    """Station rows of one route's official stops, in order; a station met twice is listed twice."""
    return _in_route_order(route_stops(net, codigo, official_only=True)).select(
        F.col("estacion_id").alias("id"),
        F.col("estacion_nombre").alias("nombre"),
        "latitud",
        "longitud",
        F.col("tipo_estacion").alias("tipo"),
        F.col("estado_estacion").alias("estado"),
        "direccion",
    )


def route_ends(net: Network) -> DataFrame:
    """Origin and destination of each route; null where the station is unknown."""
    origin = net.estacion.select(F.col("id").alias("estacion_origen_id"), F.col("nombre").alias("origen"))
    destination = net.estacion.select(F.col("id").alias("estacion_destino_id"), F.col("nombre").alias("destino"))
    return (
        net.ruta.join(origin, "estacion_origen_id", "left")
        .join(destination, "estacion_destino_id", "left")
        .select(
            F.col("codigo").alias("ruta_codigo"), F.col("nombre").alias("ruta_nombre"),
            "origen", "destino", "estado", "fecha_creacion",
        )
        .orderBy(*_asc("ruta_codigo"))
    )


def _count_per(dimension: DataFrame, facts: DataFrame, foreign_key: str, names: dict[str, str], total: str) -> DataFrame:
    """Rows of ``facts`` per named entry of ``dimension``, zero where there are none."""
    owned = (
        facts.filter(F.col("id").isNotNull())
        .groupBy(F.col(foreign_key).alias("id"))
        .agg(F.count("*").alias("_n"))
    )
    labels = [F.col(old).alias(new) for old, new in names.items()]
    # grouped by name, not id: entries that share a name are reported together
    return (
        dimension.join(owned, "id", "left")
        .groupBy(*labels)
        .agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias(total))
        .orderBy(*_asc(*names.values()))
    )


def bus_count_per_route(net: Network) -> DataFrame:
    return _count_per(net.ruta, net.bus, "ruta_id", {"codigo": "ruta_codigo", "nombre": "ruta_nombre"}, "cantidad_buses")


def user_total(net: Network) -> DataFrame:
    return net.persona.agg(F.count("*").alias("total_usuarios"))


def users_by_status(net: Network) -> DataFrame:
    return net.persona.groupBy("estado").agg(F.count("*").alias("cantidad")).orderBy(*_asc("estado"))


def users_by_person_type(net: Network) -> DataFrame:
    return _count_per(net.tipo_persona, net.persona, "tipo_persona_id", {"nombre": "tipo_persona"}, "cantidad_usuarios")


def users_by_document_type(net: Network) -> DataFrame:
    return _count_per(net.tipo_documento, net.persona, "tipo_documento_id", {"nombre": "tipo_documento"}, "cantidad_usuarios")


def user_listing(net: Network) -> DataFrame:
    document = net.tipo_documento.select(F.col("id").alias("tipo_documento_id"), F.col("nombre").alias("tipo_documento"))
    person = net.tipo_persona.select(F.col("id").alias("tipo_persona_id"), F.col("nombre").alias("tipo_persona"))
    return (
        net.persona.join(document, "tipo_documento_id")
        .join(person, "tipo_persona_id")
        .select("id", "nombres", "apellidos", "tipo_documento", "documento", "tipo_persona", "estado", "fecha_creacion")
        .orderBy(*_asc("id"))
    )
