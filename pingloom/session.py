"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Scratch paths handed out by this process, for clear_scratch.
_written: list[str] = []


def build_session(app: str = "pingloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    UTC because dates, hours and naive timestamps are all UTC; ANSI stays on, so bad input has to be
    handled with ``try_*`` expressions instead of turning silently into null.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"pingloom-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    A local master may fall back on a temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would be lost with the machine.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def spool(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the folders inside one.

    Neither this nor :func:`remove` can be said with readers and writers, so both ask the file system.
    """
    files, target = _file_system(spark, folder)
    if not files.exists(target):
        return []
    return [status.getPath().toString() for status in files.listStatus(target) if status.isDirectory()]


def finished_folders(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the folders inside one that a job has finished, which its success mark tells."""

    def is_finished(path: str) -> bool:
        files, mark = _file_system(spark, f"{path}/_SUCCESS")
        return files.exists(mark)

    return [path for path in folders(spark, folder) if is_finished(path)]


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is in it."""
    files, target = _file_system(spark, folder)
    files.delete(target, True)


def clear_scratch(spark: SparkSession, keep: Sequence[str] = ()) -> None:
    """Delete what this application has written out on its way; frames read from it cannot be used any more."""
    for path in [p for p in _written if p.startswith(shared_dir(spark)) and p not in keep]:
        remove(spark, path)
        _written.remove(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
