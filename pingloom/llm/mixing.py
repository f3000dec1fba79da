"""Mixing sources to target weights by proportionate-fair scheduling.

A source's documents stand in a fixed pseudo-random order and are cut into blocks of ``block_chars`` characters. Time
is counted in slots of one block. With a share of e slots in a period of Q, block i of a source is released at
floor(i Q / e) and due at ceil((i + 1) Q / e); of the released blocks the one with the earliest deadline goes next.
As the shares fill the period, every block meets its deadline, so at any slot a source is less than one block away from
its target line.

The order repeats every period, so only one period is laid out, from the shares alone; the slot of any block follows by
arithmetic. When a source has given all its blocks it leaves, and a new phase begins with the shares of the rest; the
last, shorter period of a phase has its shares rounded to whole blocks. Every document comes exactly once
(``exhausted="leave"``), or sources start over until each has been read whole (``exhausted="repeat"``).

A third of all rows may come from one source: places in the order are numbered within slices of a source, and only
the totals of the slices are summed per source.

Defined cases: a null source is a source of its own; a null or empty text has length 0 and goes with the block where it
falls; a text longer than a block fills as many slots as it is long and stands in the first; equal documents are ordered
by id and a hash of the text; rows that repeat stay; no rows give no rows; input columns named like the added ones are replaced.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 1 << 14
PERIOD = 1000
SLICES = 1024
# The schedule is laid out for each source; more are an error, since they would have to be grouped to be weighted.
MAX_SOURCES = 500
# Without given weights a source counts with its size to this power.
TEMPERATURE = 0.5
ADDED = ("block", "slot", "release", "deadline", "place", "epoch")


def period(shares: dict[int, int]) -> dict[int, list[int]]:
    """Slots of the blocks of each source in one period, earliest deadline first."""
    total = sum(shares.values())
    waiting = [(0, -(-total // e), s, 0) for s, e in shares.items() if e]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots: dict[int, list[int]] = {s: [] for s in shares}
    for now in range(total):
        while waiting and waiting[0][0] <= now:
            _, due, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, i))
        _, s, i = heapq.heappop(ready)
        slots[s].append(now)
        if i + 1 < shares[s]:
            e = shares[s]
            heapq.heappush(waiting, ((i + 1) * total // e, -(-(i + 2) * total // e), s, i + 1))
    return slots


def whole_shares(weights: dict[int, float], total: int) -> dict[int, int]:
    """Weights as whole numbers of slots, at least one each, that sum to ``total``; the largest remainders round up."""
    scale = (total - len(weights)) / sum(weights.values())
    exact = {s: 1 + w * scale for s, w in weights.items()}
    shares = {s: int(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (shares[s] - exact[s], s))[: total - sum(shares.values())]
    return {s: n + (s in rest) for s, n in shares.items()}


@dataclass(frozen=True)
class Part:
    """``times`` equal periods: a source's blocks from number ``first`` on, ``share`` each period, from slot ``slot``."""

    first: int
    share: int
    slot: int
    length: int
    offsets: list[int]


def plan(blocks: dict[int, int], weights: dict[int, float], exhausted: str = "leave", length: int = PERIOD) -> dict[int, list[Part]]:
    """The parts of the schedule for each source, from the number of its blocks and its weight."""
    parts: dict[int, list[Part]] = {s: [] for s in blocks}
    given = dict.fromkeys(blocks, 0)
    now = 0

    def lay(shares: dict[int, int], times: int) -> None:
        nonlocal now
        size = sum(shares.values())
        for s, offsets in period(shares).items():
            if offsets:
                parts[s].append(Part(given[s], shares[s], now, size, offsets))
                given[s] += times * shares[s]
        now += times * size

    if exhausted == "repeat":
        lay(whole_shares(weights, max(length, 2 * len(blocks))), 1)
        return parts
    while left := {s: n - given[s] for s, n in blocks.items() if n > given[s]}:
        shares = whole_shares({s: weights[s] for s in left}, max(length, 2 * len(left)))
        ends = min(left, key=lambda s: (left[s] / shares[s], s))
        times = left[ends] // shares[ends]
        if times:
            lay(shares, times)
        part = left[ends] / shares[ends] - times
        rest = {s: min(left[s] - times * e, round(part * e)) for s, e in shares.items()}
        rest[ends] = left[ends] - times * shares[ends]
        if sum(rest.values()):
            lay(rest, 1)
    return parts


def _ordered(documents: DataFrame, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in their source, in characters, and the length of each source."""
    order = F.xxhash64("doc_id", F.lit("order"))
    rows = documents.drop(*ADDED).withColumns({
        # A null source under a key that equi-joins can use.
        "__name": F.coalesce("source", F.lit("")), "__none": F.col("source").isNull(),
        "__slice": F.pmod(order, F.lit(SLICES)).cast("int"), "__order": order, "__tie": F.xxhash64("text"),
        "__size": F.coalesce(F.length("text"), F.lit(0)).cast("long"),
    })
    keys = ["__name", "__none", "__slice"]
    slices = rows.groupBy(keys).agg(F.sum("__size").alias("__chars"))
    before = Window.partitionBy("__name", "__none").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = slices.select(*keys, F.coalesce(F.sum("__chars").over(before), F.lit(0)).alias("__base"))
    earlier = Window.partitionBy(keys).orderBy("__order", "doc_id", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__place", F.coalesce(F.sum("__size").over(earlier), F.lit(0))).join(bases, keys)
    placed = placed.withColumn("place", F.col("__place") + F.col("__base"))
    lengths = slices.groupBy("__name", "__none").agg(F.sum("__chars").alias("chars"))
    return placed.withColumn("block", F.floor(F.col("place") / block_chars).cast("long")), lengths


def mix(
    documents: DataFrame,
    weights: dict[str | None, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    exhausted: str = "leave",
) -> DataFrame:
    """The documents with their block, slot, release, deadline, place and epoch.

    Reading them by slot, then place, gives the mix. ``weights`` are positive numbers by source; a source that is not
    named gets the mean of those given.
    """
    spark = documents.sparkSession
    placed, lengths = _ordered(documents, block_chars)
    rows = lengths.orderBy(F.col("__none").desc(), "__name").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them before they are weighted")
    blocks = {i: r["chars"] // block_chars + 1 for i, r in enumerate(rows)}
    if weights is None:
        target = {i: float(blocks[i]) ** TEMPERATURE for i in blocks}
    else:
        if not weights or min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        other = sum(weights.values()) / len(weights)
        target = {i: float(weights.get(None if r["__none"] else r["__name"], other)) for i, r in enumerate(rows)}
    laid = plan(blocks, target, exhausted) if blocks else {}
    if exhausted == "repeat" and blocks:
        periods = max(-(-blocks[i] // laid[i][0].share) for i in blocks)
    else:
        periods = 0
    table = spark.createDataFrame(
        [
            (r["__name"], r["__none"], blocks[i], periods * laid[i][0].share, [(p.first, p.share, p.slot, p.length, p.offsets) for p in laid[i]])
            for i, r in enumerate(rows)
        ],
        "__name string, __none boolean, __blocks long, __wanted long, "
        "__parts array<struct<first: long, share: int, slot: long, length: int, offsets: array<int>>>",
    )
    found = placed.join(F.broadcast(table), ["__name", "__none"])
    if exhausted == "repeat":
        epochs = F.floor((F.col("__wanted") - 1 - F.col("block")) / F.col("__blocks")).cast("long")
        found = found.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs)))
    else:
        found = found.withColumn("epoch", F.lit(0).cast("long"))
    number = F.col("block") + F.col("epoch") * F.col("__blocks")
    found = found.withColumn("__part", F.element_at(F.filter("__parts", lambda p: p["first"] <= number), -1))
    share, length = F.col("__part.share"), F.col("__part.length")
    turn = number - F.col("__part.first")
    begin = F.col("__part.slot") + F.floor(turn / share) * length
    i = turn % share
    return found.select(
        *[c for c in documents.columns if c not in ADDED],
        "block",
        (begin + F.element_at("__part.offsets", (i + 1).cast("int"))).cast("long").alias("slot"),
        (begin + F.floor(i * length / share)).cast("long").alias("release"),
        (begin + F.ceil((i + 1) * length / share)).cast("long").alias("deadline"),
        "place", "epoch",
    )


def in_order(mixed: DataFrame, n: int) -> DataFrame:
    """The documents in the order of the mix over ``n`` partitions, without the added columns."""
    key = ("slot", "place", "doc_id")
    return mixed.repartitionByRange(n, *key).sortWithinPartitions(*key).drop(*ADDED)
