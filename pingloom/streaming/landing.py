"""Continuous ingest: raw pings in, history, rejects and latest positions out."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pingloom import schemas
from pingloom.operators import ingest
from pingloom.operators.retention import RETENTION_HOURS, unexpired
from pingloom.plans.lookup import Positions
from pingloom.session import finished_folders, remove, scratch_path, spool
from pingloom.sources.pings import bodies, landed_text
from pingloom.streaming.snapshot import Snapshot, numbers

ACCEPTED, REJECTED = "accepted", "rejected"

RAW = "value string, arrived_at timestamp, seq bigint"

# Pings that agree in these are the same ping, delivered again.
PING_KEY = ("bus_id", "timestamp", "ingested_at")
# Distinct vehicles that the membership filter of a packed file is made for; more make it less sharp, never wrong.
PACKED_VEHICLES = 100_000


def body_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None, whole: bool = False) -> DataFrame:
    """Landed bodies as a stream: bare documents, one per line, or one per file (``whole``), whatever its line breaks."""
    reader = landed_text(spark.readStream, whole)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return bodies(reader.load(folder), whole)


def raw_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed pings (JSON lines of ``value, arrived_at, seq``) as a stream."""
    reader = spark.readStream.schema(schemas.struct(RAW))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


class Store:
    """Folder layout of an ingest.

    ``pings/batch_id=…/outcome=…/fecha=…`` holds accepted and rejected pings, sorted by vehicle within a file;
    ``latest/batch_id=…`` holds the buckets of the latest positions that a batch has changed; ``marks/batch_id=…`` the newest
    event time seen up to a batch. A batch owns its folders, so a batch that is run again after a failure replaces what it
    had written. ``compact`` gathers the batches up to a number in ``packed/upto=…``, without what has expired, and drops
    what that makes superfluous; packed pings keep the number of their batch.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.pings = f"{self.root}/pings"
        self.packed = f"{self.root}/packed"
        self.marks = f"{self.root}/marks"
        self.snapshot = Snapshot(f"{self.root}/latest")
        self.checkpoint = f"{self.root}/checkpoint"

    def batch_folder(self, batch_id: int) -> str:
        return f"{self.pings}/batch_id={batch_id}"

    def packed_folder(self, upto: int) -> str:
        return f"{self.packed}/upto={upto}"

    def _stored(self, spark: SparkSession) -> DataFrame:
        """All pings: those gathered last, and the batches after them."""
        upto = _last_number(spark, self.packed)
        parts = []
        if upto is not None:
            parts.append(spark.read.schema(schemas.struct(_PINGS)).parquet(self.packed_folder(upto)))
        after = -1 if upto is None else upto
        if any(n > after for n in _numbers(spark, self.pings)):
            batches = spark.read.schema(schemas.struct(_PINGS)).option("basePath", self.pings)
            parts.append(batches.parquet(self.pings).filter(F.col("batch_id") > after))
        if not parts:
            return spark.createDataFrame([], schemas.struct(_PINGS))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def history(self, spark: SparkSession) -> DataFrame:
        """Accepted pings, repeats included. ``fecha`` is there to prune by date."""
        return self._stored(spark).filter(F.col("outcome") == ACCEPTED).select(*schemas.columns(schemas.POSITION), "fecha")

    def rejects(self, spark: SparkSession) -> DataFrame:
        found = self._stored(spark).filter(F.col("outcome") == REJECTED)
        return found.select("arrival_seq", "ingested_at", "reject_reason", "raw")

    def history_of(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """Accepted pings of the batches after one and up to another, whether packed or not."""
        found = self._stored(spark).filter((F.col("outcome") == ACCEPTED) & (F.col("batch_id") > after) & (F.col("batch_id") <= upto))
        return found.select(*schemas.columns(schemas.POSITION))

    def last_batch(self, spark: SparkSession) -> int | None:
        """The last batch that is stored completely."""
        return max(self.snapshot.batches(spark), default=None)

    def latest(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The latest positions after a batch."""
        return self.snapshot.read(spark, batch_id)

    def current(self, spark: SparkSession) -> DataFrame:
        """The latest positions after the last complete batch; none before the first."""
        return self.snapshot.read(spark)

    def positions(self, spark: SparkSession, stations: DataFrame) -> Positions:
        """What lookups read, from the stored tables alone."""
        return Positions(latest=self.current(spark), history=self.history(spark), stations=stations)

    def write_batch(
        self, decoded: DataFrame, batch_id: int, order: str = "arrival", repeats: timedelta | None = None
    ) -> None:
        """Store one batch: a single pass over the raw pings, then a merge into the buckets of the latest positions.

        Nothing is shuffled before the pings are written, unless repeats are to be dropped: a batch spans few dates, so
        gathering by date would send most of it to one task.
        """
        spark = decoded.sparkSession
        held = None
        if repeats is not None:
            # judged pings go two ways from here: read back, they are not decoded once for each
            held = scratch_path(spark, "decoded")
            decoded.write.parquet(held)
            decoded = self.without_repeats(spark.read.schema(decoded.schema).parquet(held), batch_id, repeats)
        outcome = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
        day = F.when(F.col("reject_reason").isNull(), F.to_date("timestamp"))
        (
            decoded.withColumn("outcome", outcome)
            .withColumn("fecha", day)
            .sortWithinPartitions("outcome", "fecha", "bus_id")
            .write.mode("overwrite")
            .partitionBy("outcome", "fecha")
            .parquet(self.batch_folder(batch_id))
        )
        if held is not None:
            remove(spark, held)
        written = self._batch_history(spark, batch_id)
        # an event time ahead of its arrival is a wrong clock, and does not move the mark
        newest = written.agg(F.max(F.least("timestamp", "ingested_at")).alias("newest"))
        newest.unionByName(self._marks(spark, batch_id)).agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(
            f"{self.marks}/batch_id={batch_id}"
        )
        self.snapshot.merge(written, batch_id, order)

    def _marks(self, spark: SparkSession, before: int) -> DataFrame:
        """The newest event time up to the batch before one, as a row; no row if there is none."""
        known = [n for n in _numbers(spark, self.marks) if n < before]
        shape = schemas.struct("newest timestamp")
        return spark.read.schema(shape).parquet(f"{self.marks}/batch_id={max(known)}") if known else spark.createDataFrame([], shape)

    def remembered(self, spark: SparkSession, batch_id: int, repeats: timedelta) -> DataFrame:
        """The keys of stored pings that a batch is compared with: those not older than ``repeats`` before the newest event.

        The store itself is this memory. Older dates are not opened, so its size is bounded by the time it spans.
        """
        newest = (self._marks(spark, batch_id).first() or [None])[0]
        stored = self._stored(spark).filter((F.col("outcome") == ACCEPTED) & (F.col("batch_id") < batch_id))
        if newest is None:
            return stored.select(*PING_KEY).limit(0)
        limit = newest - repeats
        return stored.filter((F.col("fecha") >= F.lit(limit).cast("date")) & (F.col("timestamp") >= F.lit(limit))).select(*PING_KEY)

    def without_repeats(self, decoded: DataFrame, batch_id: int, repeats: timedelta) -> DataFrame:
        """A batch without pings that were delivered before, in it or in an earlier one.

        Pings behind the horizon cannot be told from repeats and stay, as do rejected ones. Of equal keys in a batch, the
        first to arrive stays.
        """
        spark = decoded.sparkSession
        newest = (self._marks(spark, batch_id).first() or [None])[0]
        inside = F.col("reject_reason").isNull()
        if newest is not None:
            inside = inside & (F.col("timestamp") >= F.lit(newest - repeats))
        first = F.min_by(F.struct(*decoded.columns), F.struct(F.col("arrival_seq").isNull(), F.col("arrival_seq")))
        once = decoded.filter(inside).groupBy(*[F.col(c).alias(f"_{c}") for c in PING_KEY]).agg(first.alias("_row")).select("_row.*")
        seen = self.remembered(spark, batch_id, repeats).withColumnsRenamed({c: f"_{c}" for c in PING_KEY})
        same = [F.col(c) == F.col(f"_{c}") for c in PING_KEY]
        return once.join(seen, same, "left_anti").unionByName(decoded.filter(~F.coalesce(inside, F.lit(False))))

    def _batch_history(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return (
            spark.read.schema(schemas.struct(_PINGS))
            .parquet(self.batch_folder(batch_id))
            .filter(F.col("outcome") == ACCEPTED)
            .select(*schemas.columns(schemas.POSITION))
        )

    def compact(self, spark: SparkSession, as_of: datetime | str, hours: int = RETENTION_HOURS, keep_snapshots: int = 2) -> None:
        """Gather all finished batches in files of even size, without accepted pings that have expired.

        To be run between ingests. What is stored stays readable until the new files are complete; then the batches they
        replace, the older gathering and superseded buckets of the latest positions are deleted. A file gets a membership filter
        of its vehicles, so a lookup of one opens no row group of files that do not have it.
        """
        done = self.last_batch(spark)
        if done is None:
            return
        stored = self._stored(spark)
        alive = unexpired(stored.filter(F.col("outcome") == ACCEPTED), as_of, hours)
        kept = alive.unionByName(stored.filter(F.col("outcome") == REJECTED))
        # the state of the snapshot's batch may have been gathered before, so a new number is taken
        upto = max(done, *_numbers(spark, self.pings), -1)
        folder = f"{self.packed_folder(upto)}"
        if upto in _numbers(spark, self.packed):
            kept = spool(kept, "kept")
        (
            kept.hint("rebalance", "outcome", "fecha")
            .sortWithinPartitions("outcome", "fecha", "bus_id")
            .write.mode("overwrite")
            .option("parquet.bloom.filter.enabled#bus_id", True)
            .option("parquet.bloom.filter.expected.ndv#bus_id", PACKED_VEHICLES)
            .partitionBy("outcome", "fecha")
            .parquet(folder)
        )
        for n in _numbers(spark, self.packed):
            if n != upto:
                remove(spark, self.packed_folder(n))
        for n in _numbers(spark, self.pings):
            if n <= upto:
                remove(spark, self.batch_folder(n))
        self.snapshot.forget(spark, keep_snapshots)
        for n in _numbers(spark, self.marks)[:-1]:
            remove(spark, f"{self.marks}/batch_id={n}")


_PINGS = schemas.POSITION + ", reject_reason string, raw string, outcome string, fecha date, batch_id bigint"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete ``name=number`` folders inside one, as few as there are batches."""
    return numbers(finished_folders(spark, folder))


def _last_number(spark: SparkSession, folder: str) -> int | None:
    return max(_numbers(spark, folder), default=None)


def start_ingest(
    raw: DataFrame, store: Store, order: str = "arrival", repeats: timedelta | None = None
) -> StreamingQuery:
    """Process everything that has landed so far, then stop; call again to go on where it ended.

    With ``repeats``, a ping that is delivered again within that time of event time is not stored again.
    """
    decoded = ingest.decode(raw, "value", "arrived_at", "seq")
    return (
        decoded.writeStream.foreachBatch(lambda df, batch_id: store.write_batch(df, batch_id, order, repeats))
        .option("checkpointLocation", store.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_batch(query: StreamingQuery) -> int | None:
    """Number of the last batch a finished run wrote, None if nothing was new."""
    return max((int(p["batchId"]) for p in query.recentProgress if p["numInputRows"] > 0), default=None)
