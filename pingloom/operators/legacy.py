"""Reading old and current ping documents together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What an old document means when the field is missing.
DEFAULT_STATUS = "DESCONOCIDO"
DEFAULT_SPEED = 0.0


def modernise(old: DataFrame) -> DataFrame:
    """Old documents (``_id, last_position, speed, status``) in current column names."""
    coordinates = F.col("last_position.coordinates")
    return old.select(
        F.col("_id").alias("bus_id"),
        F.get(coordinates, F.lit(0)).alias("lon"),
        F.get(coordinates, F.lit(1)).alias("lat"),
        F.coalesce(F.col("status"), F.lit(DEFAULT_STATUS)).alias("estado"),
        F.coalesce(F.col("speed").try_cast("double"), F.lit(DEFAULT_SPEED)).alias("velocidad_kmh"),
    )


def read_together(current: DataFrame, old: DataFrame) -> DataFrame:
    """Both versions in one table; columns the old one lacks are null."""
    return current.unionByName(modernise(old), allowMissingColumns=True)
