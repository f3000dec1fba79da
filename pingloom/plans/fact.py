"""The position fact: from history documents to the 19-column table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom import schemas
from pingloom.functions import geo, timing


def build_fact(history: DataFrame) -> DataFrame:
    """One narrow projection over the history.

    Accepts documents with a GeoJSON ``location`` as well as positions with flat ``lon``/``lat``.
    """
    if "location" in history.columns:
        coordinates = F.col("location.coordinates")
        lon, lat = geo.coordinate(coordinates, 0), geo.coordinate(coordinates, 1)
    else:
        lon, lat = F.col("lon"), F.col("lat")

    event = F.col("timestamp").try_cast("timestamp")
    arrival = F.col("ingested_at").try_cast("timestamp")

    def number(column, digits):
        return F.round(column.try_cast("double"), digits)

    columns = {
        "bus_id": F.col("bus_id"),
        "ruta": F.col("ruta"),
        "escenario": F.col("escenario"),
        "estado": F.col("estado"),
        "ts_evento": event,
        "ts_ingesta": arrival,
        "latencia_seg": timing.latency_seconds(event, arrival),
        "fecha": F.to_date(event),
        "hora": F.hour(event),
        "dia_semana": F.dayofweek(event),  # Sunday is 1
        "lon": number(lon, 6),
        "lat": number(lat, 6),
        "velocidad_kmh_num": number(F.col("velocidad_kmh"), 2),
        "fraccion_num": number(F.col("tramo.fraccion"), 3),
        "tramo_inicio": F.col("tramo.inicio"),
        "tramo_fin": F.col("tramo.fin"),
        "steps_per_segment_num": F.col("metrics_runtime.steps_per_segment").try_cast("int"),
        "current_step_num": F.col("metrics_runtime.current_step").try_cast("int"),
        "steps_remaining_num": F.col("metrics_runtime.steps_remaining").try_cast("int"),
    }
    return history.select(*[columns[name].alias(name) for name in schemas.columns(schemas.FACT)])


def preview(history: DataFrame, rows: int = 20) -> DataFrame:
    """The first facts by event time, for a look. No task keeps more than ``rows`` rows to find them."""
    return build_fact(history.orderBy("timestamp", "arrival_seq").limit(rows))
