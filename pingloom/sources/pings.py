"""Reading ping documents and stored positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from pingloom import schemas
from pingloom.operators import quality

# Formats whose files or collections hold whole documents.
DOCUMENT_FORMATS = ("json", "parquet", "orc", "avro", "mongodb")


def read_documents(
    spark: SparkSession, path: str | None, fmt: str = "json", schema: str | None = None, additive: bool = False, **options: str
) -> DataFrame:
    """Scan a document collection with a given schema, so that no pass is spent on inferring one.

    With ``additive`` the schema is inferred as well, which costs a pass, and what it has beyond the given one is read
    too; nothing given is removed or retyped.
    """
    if fmt not in DOCUMENT_FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {DOCUMENT_FORMATS}")

    def load(kind: T.StructType | None) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        reader = reader.schema(kind) if kind else reader
        return reader.load(path) if path else reader.load()

    registered = schemas.struct(schema) if schema else None
    return load(quality.additive_schema(registered, load(None).schema) if registered and additive else registered)


def landed_text(reader: DataFrameReader | DataStreamReader, whole: bool) -> DataFrameReader | DataStreamReader:
    """A text reader for bodies: a file at a time (``whole``), or a line at a time, so that a file of lines may be of any size."""
    reader = reader.format("text")
    return reader.option("wholetext", True) if whole else reader.option("lineSep", "\n")


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with their place in the file; lines of a part of a file come in a row, and a part has fewer lines than bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}
        for batch in batches:
            path, start = batch.column("path"), batch.column("start")
            place = np.empty(batch.num_rows, np.int64)
            kinds = pa.table({"path": path, "start": start, "at": np.arange(batch.num_rows)}).group_by(["path", "start"])
            for rows in kinds.aggregate([("at", "min"), ("at", "count")]).to_pylist():
                key, low, n = (rows["path"], rows["start"]), rows["at_min"], rows["at_count"]
                # the line that begins where a part ends belongs to that part
                place[low : low + n] = np.arange(n) + seen.get(key, key[1] + (key[1] > 0))
                seen[key] = int(place[low + n - 1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "line"])

    shape = "body string, path string, start bigint, arrived_at timestamp, line bigint"
    return lines.mapInArrow(count, shape)


def bodies(files: DataFrame, whole: bool = False) -> DataFrame:
    """Raw pings of what :func:`landed_text` reads: ``value``, ``arrived_at`` and ``seq``.

    A file is one body (``whole``) or holds one per line. They arrive when their file lands; within a file, the place of
    the line orders them, and files that land at the same moment are told apart by their name. The place is the line's
    number, counted from the start of each part in which a large file is read.
    """
    landed = files.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )
    if whole:
        listed = landed.withColumn("line", F.lit(0).cast("bigint"))
    else:
        listed = _placed(landed).withColumn("body", F.regexp_replace("body", r"\r\z", ""))
    file = F.pmod(F.xxhash64("path"), F.lit(1 << 20))
    return listed.filter(F.trim("body") != "").select(
        F.col("body").alias("value"), "arrived_at", (F.col("line") * F.lit(1 << 20) + file).alias("seq")
    )


def read_landing(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Raw ping text stamped with the time its file landed and its place in the file."""
    return bodies(landed_text(spark.read, whole).load(path), whole)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.struct(schemas.POSITION)).parquet(path)
