"""Neighbours and positions within ordered groups of any size.

Rows are range-partitioned by group and order, so a group that holds a large share of the data lies over several
partitions, its blocks, and a small group lies in one. Every block is handled on its own, and one row per block is
exchanged to stitch the blocks of a group together. Nulls in the order come last; rows that tie on it are ordered by a
hash of all their columns, so only equal rows are in an arbitrary order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingloom.session import shuffle_partitions, spool


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _comparable(order: Sequence[str]) -> Column:
    """A struct that compares like the order, nulls last."""
    return F.struct(*[f for c in order for f in (F.col(c).isNull(), F.col(c))])


def _in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with ``_block`` numbers that ascend in group order.

    Written out once: the borders of the blocks are drawn from a sample, and must be the same for every use and when a
    task is rerun.
    """
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    ranged = tied.repartitionByRange(shuffle_partitions(df.sparkSession), *keys, *_ascending(order), "_tie")
    return spool(ranged.withColumn("_block", F.spark_partition_id()), "blocks")


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Add ``_next``: a struct of ``fields`` from the following row of the group, null for its last row."""
    blocks = _in_blocks(df, keys, order).withColumn("_ahead", F.lit(False))
    carried = list(dict.fromkeys([*order, "_tie", *fields]))
    first_rows = blocks.groupBy(*keys, "_block").agg(
        F.min_by(F.struct(*carried), _comparable([*order, "_tie"])).alias("_first")
    )
    # a group has at most as many blocks as there are shuffle partitions
    earlier = F.lag("_block").over(Window.partitionBy(*keys).orderBy("_block"))
    ahead = (
        first_rows.withColumn("_to", earlier)
        .filter(F.col("_to").isNotNull())
        .select(*keys, F.col("_to").alias("_block"), F.lit(True).alias("_ahead"),
                *[F.col("_first")[c].alias(c) for c in carried if c not in keys])
    )
    # equal rows may lie on both sides of a border: the one from ahead comes after those of its block
    within = Window.partitionBy(*keys, "_block").orderBy(*_ascending(order), "_tie", "_ahead")
    return (
        blocks.unionByName(ahead, allowMissingColumns=True)
        .withColumn("_next", F.lead(F.struct(*fields)).over(within))
        .filter(~F.col("_ahead"))
        .drop("_ahead", "_block", "_tie")
    )


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_pos``: the 0-based place of each row in its group."""
    blocks = _in_blocks(df, keys, order)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    # joined by null-safe equality so that a null key keeps its rows
    names = {c: f"_o_{c}" for c in [*keys, "_block"]}
    offsets = offsets.withColumnsRenamed(names)
    condition = F.col("_block") == F.col("_o__block")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(names[k]))
    within = Window.partitionBy(*keys, "_block").orderBy(*_ascending(order), "_tie")
    return (
        blocks.withColumn("_in_block", F.row_number().over(within).cast("bigint") - 1)
        .join(offsets, condition)
        .withColumn("_pos", F.col("_offset") + F.col("_in_block"))
        .select(*df.columns, "_pos")
    )
