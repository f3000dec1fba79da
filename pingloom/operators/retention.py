"""Expiry of old history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: history older than this many hours expires.
RETENTION_HOURS = 24

PARTITION = "fecha"


def _cutoff(as_of: datetime | str, hours: int) -> Column:
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))


def unexpired(history: DataFrame, as_of: datetime | str, hours: int = RETENTION_HOURS) -> DataFrame:
    """History rows still alive at ``as_of``, by event time. Rows without a time never expire.

    Where the history is stored by date, folders of expired dates are not opened.
    """
    cutoff = _cutoff(as_of, hours)
    alive = history.filter((F.col("timestamp") > cutoff) | F.col("timestamp").isNull())
    if PARTITION in history.columns:
        alive = alive.filter((F.col(PARTITION) >= F.to_date(cutoff)) | F.col(PARTITION).isNull())
    return alive


def rewrite(history: DataFrame, path: str, as_of: datetime | str, hours: int = RETENTION_HOURS) -> None:
    """Write the living part of a history to a new place, one folder per date.

    The old place stays as it is until the caller drops it, so a failed run loses nothing.
    """
    alive = unexpired(history, as_of, hours).withColumn(PARTITION, F.to_date("timestamp"))
    alive.hint("rebalance", PARTITION).write.partitionBy(PARTITION).parquet(path)
