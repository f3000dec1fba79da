"""The latest position per vehicle in buckets, of which a batch rewrites only those it touches.

``batch_id=…/bucket=…`` under the root holds a bucket as it is after a batch. The state after a batch is, bucket by bucket, the
newest version up to that batch, so what a batch writes grows with the buckets of its vehicles and not with the fleet. A batch
owns its folder; running it again replaces what it wrote, and older versions are never changed.

Rows of a file follow a space-filling curve over the map in small row groups, so a lookup around a point opens few of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingloom import schemas
from pingloom.functions import geo
from pingloom.operators.latest import latest
from pingloom.session import finished_folders, folders, remove, spool

BUCKETS = 64
# Bytes in a row group: some thousand positions.
ROW_GROUP_BYTES = 256 << 10


def numbers(paths: list[str]) -> list[int]:
    """The numbers of ``name=number`` folders, ascending."""
    return sorted(int(path.rpartition("=")[2]) for path in paths if "=" in path.rpartition("/")[2])


class Snapshot:
    """Versions of the buckets of a latest table; the number of buckets stays as it is for the life of a table."""

    def __init__(self, root: str, buckets: int = BUCKETS):
        self.root = root.rstrip("/")
        self.buckets = buckets

    def folder(self, batch_id: int) -> str:
        return f"{self.root}/batch_id={batch_id}"

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the complete batches."""
        return numbers(finished_folders(spark, self.root))

    def versions(self, spark: SparkSession, upto: int | None = None) -> dict[int, int]:
        """For each bucket the newest batch that wrote it."""
        newest: dict[int, int] = {}
        for batch_id in self.batches(spark):
            if upto is None or batch_id <= upto:
                newest |= dict.fromkeys(numbers(folders(spark, self.folder(batch_id))), batch_id)
        return newest

    def _read(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        shape = schemas.struct(schemas.POSITION)
        paths = [f"{self.folder(n)}/bucket={b}" for b, n in sorted(versions.items())]
        return spark.read.schema(shape).parquet(*paths) if paths else spark.createDataFrame([], shape)

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """One row per vehicle, as of a batch or of the last one."""
        return self._read(spark, self.versions(spark, upto))

    def merge(self, positions: DataFrame, batch_id: int, order: str = "arrival") -> None:
        """Bring the positions of a batch into the table."""
        spark = positions.sparkSession
        bucket = F.pmod(F.xxhash64("bus_id"), F.lit(self.buckets)).cast("int")
        changed = spool(latest(positions, order=order), "changed")
        # as many numbers as there are buckets at most
        touched = {r["bucket"] for r in changed.select(bucket.alias("bucket")).distinct().collect()}
        stored = {b: n for b, n in self.versions(spark, batch_id - 1).items() if b in touched}
        rows = latest(self._read(spark, stored).unionByName(changed), order=order) if stored else changed
        (
            rows.withColumn("bucket", bucket)
            .withColumn("_curve", geo.curve_key(F.col("lat"), F.col("lon")))
            .hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", "_curve")
            .drop("_curve")
            .write.mode("overwrite")
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .partitionBy("bucket")
            .parquet(self.folder(batch_id))
        )

    def forget(self, spark: SparkSession, keep: int) -> None:
        """Delete versions that no state needs but those before the last ``keep`` batches."""
        kept = self.batches(spark)[-keep:]
        if not kept:
            return
        needed = self.versions(spark, kept[0])
        for batch_id in self.batches(spark):
            if batch_id < kept[0]:
                old = [b for b in numbers(folders(spark, self.folder(batch_id))) if needed.get(b) != batch_id]
                for bucket in old:
                    remove(spark, f"{self.folder(batch_id)}/bucket={bucket}")
                if batch_id not in needed.values():
                    remove(spark, self.folder(batch_id))
