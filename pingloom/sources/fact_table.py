"""The fact table on shared storage: Parquet, one folder per event date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingloom import schemas
from pingloom.session import finished_folders, folders, remove, spool

PARTITION = "fecha"

# Two facts are the same event when all of these agree.
EVENT_KEY = ("bus_id", "ts_evento", "ts_ingesta")


def _laid_out(fact: DataFrame) -> DataFrame:
    """Rows gathered by date into files of even size.

    The rebalance hint lets Spark split a date that holds much of the data over many tasks and merge
    small ones; within a file, rows are sorted by vehicle so that a lookup of one skips row groups.
    """
    return fact.hint("rebalance", PARTITION).sortWithinPartitions(PARTITION, "bus_id", "ts_evento")


def write_fact(fact: DataFrame, path: str, mode: str = "snapshot") -> None:
    """Store the fact.

    ``snapshot`` replaces the whole table. ``accumulate`` keeps what is stored and merges: a stored
    row gives way to an incoming one with the same event key, everything else stays. Only dates that
    occur in the input are rewritten.
    """
    if mode == "snapshot":
        _laid_out(fact).write.mode("overwrite").partitionBy(PARTITION).parquet(path)
    elif mode == "accumulate":
        _accumulate(fact, path)
    else:
        raise ValueError(f"mode must be 'snapshot' or 'accumulate', not {mode!r}")


def _accumulate(fact: DataFrame, path: str) -> None:
    """Merge into the stored table: the input is written out once, and so is the merged part before it replaces its dates.

    Stored rows are joined with the dates of the input, so only their folders are read and no list of dates passes
    through the driver.
    """
    spark = fact.sparkSession
    if not _exists(spark, path):
        write_fact(fact, path, "snapshot")
        return
    incoming = spool(fact, "incoming")
    dates = incoming.select(F.col(PARTITION).alias("_date")).distinct()
    stored = read_fact(spark, path).join(dates, F.col(PARTITION).eqNullSafe(F.col("_date")), "left_semi")
    events = incoming.select(*EVENT_KEY).distinct()
    same_event = [F.col(f"s.{c}").eqNullSafe(F.col(f"i.{c}")) for c in EVENT_KEY]
    kept = stored.alias("s").join(events.alias("i"), same_event, "left_anti")
    merged = spool(kept.select(*fact.columns).unionByName(incoming), "merged")
    (
        _laid_out(merged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(schemas.struct(schemas.FACT)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The stored fact in its documented column order (the partition column comes back last)."""
    return (
        spark.read.schema(schemas.struct(schemas.FACT)).parquet(path).select(*schemas.columns(schemas.FACT))
    )


def _versions(paths: list[str]) -> list[int]:
    return sorted(int(p.rpartition("=")[2]) for p in paths if p.rpartition("/")[2].startswith("v="))


def publish_fact(fact: DataFrame, root: str, keep: int = 2) -> int:
    """Write a whole new version of the table beside the old ones, then switch to it; its number.

    The switch is a small table whose success mark names the version, written when the data is complete. Until then, and
    after a failure, readers get the version before. Versions that are older than the last ``keep`` are deleted afterwards, so
    readers of the version before go on undisturbed.
    """
    spark = fact.sparkSession
    version = max(_versions(folders(spark, f"{root}/data")), default=0) + 1
    _laid_out(fact).write.partitionBy(PARTITION).parquet(f"{root}/data/v={version}")
    spark.range(1).coalesce(1).write.parquet(f"{root}/current/v={version}")
    published = _versions(finished_folders(spark, f"{root}/current"))
    for old in _versions(folders(spark, f"{root}/data")):
        if old < version and old not in published[-keep:]:
            remove(spark, f"{root}/current/v={old}")
            remove(spark, f"{root}/data/v={old}")
    return version


def published_version(spark: SparkSession, root: str) -> int | None:
    """The version that readers get."""
    return max(_versions(finished_folders(spark, f"{root}/current")), default=None)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    version = published_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schemas.struct(schemas.FACT))
    return read_fact(spark, f"{root}/data/v={version}")
