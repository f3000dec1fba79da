"""Table shapes. Written as DDL because that is how they are read and reviewed."""

from __future__ import annotations

from pyspark.sql import types as T

TRAMO = "struct<inicio: string, fin: string, fraccion: double>"
METRICS = "struct<steps_per_segment: int, current_step: int, steps_remaining: int>"

TRAMO_FIELDS = ("inicio", "fin", "fraccion")
METRIC_FIELDS = ("steps_per_segment", "current_step", "steps_remaining")

# What is_whole in operators.ingest puts behind a text to see whether the reader gets there.
END_OF_TEXT = "array<struct<_end: bigint>>"

# A ping document as registered.
PING = (
    "bus_id string, ruta string, timestamp string, "
    "location struct<type: string, coordinates: array<double>>, lat double, lon double, "
    f"estado string, velocidad_kmh double, escenario string, direccion string, tramo {TRAMO}, "
    f"metrics_runtime {METRICS}"
)

# A stored document as other systems export it: times as text, location as GeoJSON.
DOCUMENT = (
    "bus_id string, ruta string, escenario string, estado string, direccion string, timestamp string, "
    "ingested_at string, location struct<type: string, coordinates: array<double>>, "
    f"velocidad_kmh double, tramo {TRAMO}, metrics_runtime {METRICS}"
)

# A ping as delivered. Everything that has to be told apart from "missing" or "wrong type" later is
# read as text first.
PING_TEXT = (
    "bus_id string, ruta string, timestamp string, lat string, lon string, "
    "location struct<coordinates: array<string>>, "
    "estado string, velocidad_kmh string, escenario string, direccion string, "
    "tramo map<string, string>, metrics_runtime map<string, string>, _broken string"
)

# The same document, keeping JSON types, for the few pings whose text form is ambiguous.
PING_VARIANT = (
    "bus_id variant, lat variant, lon variant, location variant, "
    "tramo variant, metrics_runtime variant, _broken string"
)

# A stored position (history and latest). Coordinates are flat doubles so that range filters reach
# the Parquet statistics; ``functions.geo.geojson_point`` rebuilds the GeoJSON form on output.
POSITION = (
    "bus_id string, ruta string, escenario string, estado string, direccion string, "
    "timestamp timestamp, ingested_at timestamp, arrival_seq bigint, lon double, lat double, "
    f"velocidad_kmh double, tramo {TRAMO}, metrics_runtime {METRICS}, ts_imputed boolean, extra map<string, string>"
)

FACT = (
    "bus_id string, ruta string, escenario string, estado string, ts_evento timestamp, "
    "ts_ingesta timestamp, latencia_seg bigint, fecha date, hora int, dia_semana int, lon double, "
    "lat double, velocidad_kmh_num double, fraccion_num double, tramo_inicio string, "
    "tramo_fin string, steps_per_segment_num int, current_step_num int, steps_remaining_num int"
)

NETWORK = {
    "estacion": (
        "id int, nombre string, latitud decimal(9,6), longitud decimal(9,6), tipo string, "
        "estado string, direccion string"
    ),
    "ruta": (
        "id int, codigo string, nombre string, estado string, estacion_origen_id int, "
        "estacion_destino_id int, fecha_creacion timestamp"
    ),
    "estacion_por_ruta": (
        "ruta_id int, estacion_id int, orden int, parada boolean, fecha_creacion timestamp"
    ),
    "bus": (
        "id int, ruta_id int, tipo_bus_id int, placa string, modelo string, estado string, "
        "fecha_asignacion date"
    ),
    "tipo_bus": "id int, nombre string",
    "persona": (
        "id int, nombres string, apellidos string, documento string, tipo_documento_id int, "
        "tipo_persona_id int, estado string, fecha_creacion timestamp"
    ),
    "tipo_persona": "id int, nombre string",
    "tipo_documento": "id int, nombre string",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()
