"""Paths travelled by vehicles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.operators.latest import last_n


def points(history: DataFrame, n: int = 0) -> DataFrame:
    """Path points in travel order, one per row; ``n`` keeps the newest of each vehicle (0: all).

    One row per point, so a vehicle with any number of pings can be listed.
    """
    return (
        last_n(history, n)
        .select("bus_id", "timestamp", "arrival_seq", "lat", "lon")
        .orderBy(*[F.asc_nulls_last(c) for c in ("bus_id", "timestamp", "arrival_seq")])
    )


def lines(history: DataFrame, n: int = 30) -> DataFrame:
    """One row per vehicle with its newest ``n`` points as an ordered ``[{lat, lon}]`` array."""
    if n < 1:
        raise ValueError("a line needs a positive number of points; use points() for whole paths")
    point = F.struct(F.col("timestamp").isNull().alias("timeless"), "timestamp", "arrival_seq", "lat", "lon")
    path = F.sort_array(F.collect_list(point))
    return (
        last_n(history, n)
        .groupBy("bus_id")
        .agg(path.alias("_path"))
        .select(
            "bus_id",
            F.size("_path").alias("puntos"),
            F.transform("_path", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("trayectoria"),
        )
    )
