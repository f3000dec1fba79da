"""Incremental fact loads: of history files not seen before, or of the batches of a store not loaded before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pingloom import schemas
from pingloom.plans.fact import build_fact
from pingloom.session import finished_folders
from pingloom.streaming.landing import Store
from pingloom.streaming.snapshot import numbers


def history_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.struct(schemas.POSITION))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start_fact_load(history: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new facts by date. The file sink's own log makes each file's rows appear exactly once."""
    return (
        build_fact(history)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("fecha")
        .trigger(availableNow=True)
        .start()
    )


def load_store(spark: SparkSession, store: Store, root: str) -> int | None:
    """Append the facts of the store's batches that were not loaded yet; the number of the last one, None without news.

    A load writes the folder ``upto=…`` of its last batch, and the folder's success mark is the bookmark: output and
    progress are committed together, and a load that fails is done again from where it began. Batches are told by their
    numbers, which packed files keep, so compacting the store in between neither repeats facts nor hides them.
    """
    loaded, last = max(numbers(finished_folders(spark, root)), default=-1), store.last_batch(spark)
    if last is None or last <= loaded:
        return None
    fact = build_fact(store.history_of(spark, loaded, last))
    fact.hint("rebalance", "fecha").sortWithinPartitions("fecha", "bus_id").write.mode("overwrite").partitionBy("fecha").parquet(
        f"{root}/upto={last}"
    )
    return last


def read_loaded(spark: SparkSession, root: str) -> DataFrame:
    """All facts of complete loads."""
    shape = schemas.struct(schemas.FACT + ", upto bigint")
    done = numbers(finished_folders(spark, root))
    if not done:
        return spark.createDataFrame([], schemas.struct(schemas.FACT))
    paths = [f"{root}/upto={n}" for n in done]
    return spark.read.schema(shape).option("basePath", root).parquet(*paths).select(*schemas.columns(schemas.FACT))
