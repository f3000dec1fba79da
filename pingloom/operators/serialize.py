"""Rows as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def canonical(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that every number has one JSON form."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def as_json(df: DataFrame, keep: list[str] | None = None, column: str = "json") -> DataFrame:
    """One JSON object per row (null fields included, ISO timestamps), after the ``keep`` columns."""
    options = {"timestampFormat": ISO, "timestampNTZFormat": ISO, "ignoreNullFields": "false"}
    plain = canonical(df)
    return plain.select(*(keep or []), F.to_json(F.struct(*plain.columns), options).alias(column))


def as_text(df: DataFrame) -> DataFrame:
    """The other output form: whatever JSON lacks (times, decimals) as plain strings."""
    textual = (T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, textual)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )
