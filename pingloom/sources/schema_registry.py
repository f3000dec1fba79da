"""Numbered versions of the schema of a document collection, and a log of what each extract changed.

An extract is compared with the newest version. New fields make the next version; fields that are registered but absent
are noted and stay; values of another type than registered are refused, the registered type stays. Folder layout:
``changes/e=…`` holds what an extract changed, ``fields/e=…`` the fields after it with the version they came in. The
success mark of the fields ends an extract, so after a failure in between readers see the extract before, and the next
extract replaces the unfinished one.

Both tables have one row per path and kind, whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingloom import schemas
from pingloom.operators.quality import registered_fields, schema_changes
from pingloom.session import finished_folders

FIELDS = "campo string, tipo string, version int"
CHANGES = (
    "extracto int, campo string, tipo_registrado string, tipo_observado string, documentos bigint, cambio string, "
    "accion string"
)
APPLIED, NOTED, REFUSED = "aplicado", "anotado", "rechazado"


def _last(spark: SparkSession, root: str) -> int | None:
    return max((int(p.rpartition("=")[2]) for p in finished_folders(spark, f"{root}/fields")), default=None)


def _write(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def register(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Start a registry with a schema as version 1."""
    if _last(spark, root) is not None:
        raise ValueError(f"{root} has a schema already")
    rows = [(path, kind, 1) for path, kind in registered_fields(schema)]
    _write(spark.createDataFrame(rows, FIELDS), f"{root}/fields/e=0")


def observe(raw: DataFrame, root: str, value: str = "value") -> int:
    """Compare an extract of documents with the newest version and store the outcome; the number of the extract.

    A new field that comes with several kinds gets the most frequent one, the first by name among equals; its other kinds
    are refused. One that is null throughout has no kind yet and is noted.
    """
    spark = raw.sparkSession
    last = _last(spark, root)
    if last is None:
        raise ValueError(f"{root} has no schema yet")
    extract = last + 1
    known = spark.read.schema(schemas.struct(FIELDS)).parquet(f"{root}/fields/e={last}")
    found = schema_changes(raw, known.select("campo", F.col("tipo").alias("tipo_registrado")), value)
    typed = F.col("tipo_observado") != "NULL"
    rank = F.row_number().over(Window.partitionBy("campo").orderBy(typed.desc(), F.desc("documentos"), "tipo_observado"))
    new = F.col("cambio") == "agregado"
    action = (
        F.when(new & ~typed, NOTED)
        .when(new, F.when(rank == 1, APPLIED).otherwise(REFUSED))
        .when(F.col("cambio") == "tipo", REFUSED)
        .when(F.col("cambio").isin("eliminado", "ilegible"), NOTED)
    )
    changes = found.withColumn("accion", action).filter(F.col("accion").isNotNull())
    names = schemas.columns(CHANGES)
    _write(changes.withColumn("extracto", F.lit(extract)).select(*names), f"{root}/changes/e={extract}")
    stored = spark.read.schema(schemas.struct(CHANGES)).parquet(f"{root}/changes/e={extract}")
    version = current_version(spark, root) + 1
    added = stored.filter(F.col("accion") == APPLIED).select(
        "campo", F.col("tipo_observado").alias("tipo"), F.lit(version).cast("int").alias("version")
    )
    _write(known.unionByName(added), f"{root}/fields/e={extract}")
    return extract


def current_version(spark: SparkSession, root: str) -> int | None:
    last = _last(spark, root)
    if last is None:
        return None
    return spark.read.schema(schemas.struct(FIELDS)).parquet(f"{root}/fields/e={last}").agg(F.max("version")).first()[0]


def fields(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The fields of a version, of the newest by default, with the version each came in."""
    last = _last(spark, root)
    if last is None:
        return spark.createDataFrame([], schemas.struct(FIELDS))
    rows = spark.read.schema(schemas.struct(FIELDS)).parquet(f"{root}/fields/e={last}")
    return rows if version is None else rows.filter(F.col("version") <= version)


def change_log(spark: SparkSession, root: str) -> DataFrame:
    """What the finished extracts changed."""
    last = _last(spark, root)
    if not last:
        return spark.createDataFrame([], schemas.struct(CHANGES))
    paths = [f"{root}/changes/e={e}" for e in range(1, last + 1)]
    return spark.read.schema(schemas.struct(CHANGES)).parquet(*paths)
