"""Display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
PORTAL_CODE, PORTAL_LABEL, STATION_LABEL = "P", "Portal", "Estación"
ARROW = " → "


def station_kind(tipo: Column) -> Column:
    return F.when(tipo == PORTAL_CODE, PORTAL_LABEL).otherwise(STATION_LABEL)


def segment_label(start: Column, end: Column) -> Column:
    return F.concat_ws(ARROW, start, end)


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", value)
