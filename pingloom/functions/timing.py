"""Differences between moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def latency_seconds(event: Column, arrival: Column) -> Column:
    """Whole seconds between the two, each cut to the second first."""
    return F.unix_seconds(arrival) - F.unix_seconds(event)
