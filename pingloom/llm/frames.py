"""DataFrame helpers of the operators: shipped code, bounded batches, blocks of rows, sums of hashed counts."""

from __future__ import annotations

import ctypes
import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pingloom.session import shuffle_partitions, spool

# Text that one task of a blocked operator holds, as plain bytes; raise it with the executors' memory.
BLOCK_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
# Plain bytes of text for a byte of compressed columns.
PLAIN_PER_STORED = 2
# The optimizer stands in a size near the largest long where it has none.
UNKNOWN_BYTES = 1 << 60


@cache
def _packed() -> str:
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="pingloom-code-"), "pingloom_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    return str(path)


@cache
def _send(application: str, spark: SparkSession) -> None:
    spark.sparkContext.addPyFile(_packed())


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors once, and bound what a Python worker gets at a time by bytes."""
    _send(spark.sparkContext.applicationId, spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release() -> None:
    """Give back to the system what finished work has left; workers live on for the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over the batches of a task that releases memory at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def block_count(df: DataFrame, block_bytes: int = BLOCK_BYTES, column: str = "text") -> int:
    """Number of blocks so that one holds about ``block_bytes`` of text.

    The size comes from the optimizer; where it knows none, as for rows held in memory, the texts are measured.
    """
    plain = PLAIN_PER_STORED * int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if plain > UNKNOWN_BYTES:
        plain = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(shuffle_partitions(df.sparkSession), math.ceil(plain / block_bytes))


def block_of(n: int | Column, *keys: str) -> Column:
    """Block number of a row, by a hash of some columns."""
    return F.pmod(F.xxhash64(*keys), n if isinstance(n, Column) else F.lit(n)).cast("int")


def dealt(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Rows gathered by a number from 0 to n - 1 into so many partitions that one holds about one number.

    A grouped function over ``key`` uses this partitioning, whatever ``spark.sql.shuffle.partitions`` says.
    """
    return rows.repartition(max(n, shuffle_partitions(rows.sparkSession)), key)


def hashed_sums(parts: DataFrame, size: int, *names: str) -> dict[str, np.ndarray]:
    """Sum the counts of every slot over all tasks; ``size`` slots, a constant, come to the driver.

    ``parts`` has a row (slot, counts...) for each slot a task has seen.
    """
    sums = parts.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    slots = sums["slot"].to_numpy()
    out = {n: np.zeros(size, np.int64) for n in names}
    for n in names:
        out[n][slots] = sums[n].to_numpy()
    return out


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their ``place``, from 0, in an order; sorted in ranges, so no task holds all of them."""
    # written out, so that the borders of the ranges are the same for both uses
    sorted_ = rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = spool(sorted_, "places").withColumn("_part", F.shiftright("_at", 33))
    # one number per range comes to the driver
    sizes = sorted(placed.groupBy("_part").count().collect())
    before = np.cumsum([0, *[r["count"] for r in sizes]]).tolist()
    first = rows.sparkSession.createDataFrame([(r["_part"], n) for r, n in zip(sizes, before)], "_part long, _before long")
    at = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(first), "_part").withColumn("place", at).drop("_at", "_part", "_before")


def quantiles(rows: DataFrame, column: str, *shares: float) -> list[float] | None:
    """Exact quantiles of a column, between neighbours as numpy has them; None without rows."""
    placed = spool(numbered(rows.select(column), column), "sorted")
    n = placed.count()
    if n == 0:
        return None
    spots = [(math.floor((n - 1) * share), (n - 1) * share % 1) for share in shares]
    wanted = sorted({min(k + d, n - 1) for k, _ in spots for d in (0, 1)})
    value = {r["place"]: r[column] for r in placed.filter(F.col("place").isin(wanted)).collect()}
    return [float(np.quantile([value[k], value[min(k + 1, n - 1)]], between)) for k, between in spots]
