"""Latest position per vehicle, and the last few."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingloom.session import spool

# Arrival order is the default: a late ping replaces a newer position.
ORDERS = {
    "arrival": ("ingested_at", "arrival_seq"),
    "event": ("timestamp", "ingested_at", "arrival_seq"),
}

# Spark limits ranks before the shuffle up to this setting.
RANK_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"
SLICES = 16

# Microseconds that stand for a missing time, before the year 1.
_NO_TIME = -(10**17)


def _order(order: str) -> tuple[str, ...]:
    if order not in ORDERS:
        raise ValueError(f"order must be one of {sorted(ORDERS)}, not {order!r}")
    return ORDERS[order]


def _micros(name: str) -> Column:
    return F.coalesce(F.unix_micros(F.col(name).cast("timestamp")), F.lit(_NO_TIME)).cast("decimal(20,0)")


def _packed(order: str) -> Column:
    """The order, or as much of it as fits, as one number of fixed width, which hash aggregation can keep."""
    if _order(order) == ORDERS["arrival"]:
        seq = F.coalesce(F.col("arrival_seq"), F.lit(-(2**63))).cast("decimal(20,0)") + F.lit(Decimal(2**63))
        return (_micros("ingested_at") * F.lit(Decimal(10**20)) + seq).cast("decimal(38,0)")
    arrival = _micros("ingested_at") - F.lit(Decimal(_NO_TIME))
    return (_micros("timestamp") * F.lit(Decimal(10**18)) + arrival).cast("decimal(38,0)")


def newest(rows: DataFrame, key: str = "bus_id", order: str = "arrival") -> DataFrame:
    """One row per key in a single aggregation, which sorts its input: for streams and for few rows."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*_order(order)))
    return rows.groupBy(F.col(key).alias("_key")).agg(best.alias("_row")).select("_row.*")


def latest(history: DataFrame, key: str = "bus_id", order: str = "arrival") -> DataFrame:
    """One row per key, without sorting the history.

    A hash aggregation over key and packed order finds what wins, one number per key, and is written out, so that its
    size is known when the rows are fetched by an equi-join. The few rows that reach it are settled by the full order.
    """
    packed = _packed(order)
    best = spool(
        history.select(F.col(key).alias("_key"), packed.alias("_packed")).groupBy("_key").agg(F.max("_packed").alias("_best")),
        "latest",
    )
    found = history.join(best, F.col(key).eqNullSafe(F.col("_key")) & (packed == F.col("_best")))
    return newest(found.select(*history.columns).repartition(F.col(key)), key, order)


def latest_by_rank(history: DataFrame, key: str = "bus_id", order: str = "arrival") -> DataFrame:
    """The same rows as :func:`latest`, by ranking; Spark cuts each task's input to one row per key."""
    newest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in _order(order)])
    return history.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def last_n(
    history: DataFrame,
    n: int,
    key: str = "bus_id",
    order: Sequence[Column] | None = None,
    spread_by: str = "arrival_seq",
) -> DataFrame:
    """The ``n`` newest rows of every key; ``n = 0`` means no limit.

    Ranked twice: first within a slice of each key, then over the survivors, so that a hot key is
    never ranked whole by one task. Ranks are limited before each shuffle, whatever ``n``.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return history
    order = list(order) if order is not None else [F.desc("timestamp"), F.desc("arrival_seq")]
    conf = history.sparkSession.conf
    conf.set(RANK_LIMIT_KEY, str(max(n, int(conf.get(RANK_LIMIT_KEY)))))
    within_slice = Window.partitionBy(key, "_slice").orderBy(*order)
    within_key = Window.partitionBy(key).orderBy(*order)
    return (
        history.withColumn("_slice", F.pmod(F.xxhash64(spread_by), F.lit(SLICES)))
        .withColumn("_rank", F.row_number().over(within_slice))
        .filter(F.col("_rank") <= n)
        .drop("_slice")
        .withColumn("_rank", F.row_number().over(within_key))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )
