"""Minimax contiguous partition of documents into shards; equal texts stay together.

Documents are ordered by their text's SHA-256, so equal texts are neighbours and form one
atomic group; a shard is a stretch of whole groups. The smallest capacity for which a
greedy walk needs no more than the wanted number of shards is found by binary search, and
the order is cut there: a shard takes its share of what is left, but as much as the later
shards need it to take, so that none exceeds the smallest capacity.

One shuffle of narrow rows (no texts) orders the table; running sums within its partitions
and one total per partition give every row the bytes before it. A row's shard is the
number of cuts at or before that place, so no join brings groups back to rows and a group
with a third of all rows is spread over tasks like any others.

The search never sees all groups. It works on at most :data:`CELLS` stretches of the
order, each with its first and last group start. Answers that fall between the two are
kept as intervals; stretches in doubt are looked up again in finer cells until none is.

Null texts count as empty ones and have no bytes. Null and repeated doc_ids are ordinary
rows. Sizes are at least ``overhead`` (1 or more), so no two groups start at one place.
With fewer groups than shards the last shards are empty; an empty table gives no rows.
Columns of ``docs`` that are not carried are never read; of carried ones named like a
column of the result the latter is returned.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profile_lake.session import stage

SHARDS = 24
OVERHEAD = 8
#: Stretches the driver sees of the order at once.
CELLS = 1 << 15
RESULT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


class Borders:
    """Where groups start (and the last one ends), as disjoint stretches that hold all starts.

    A stretch [low, high] has a start at both ends; where they differ there may be more.
    """

    def __init__(self, stretches: list[tuple[int, int]], total: int):
        self.total = total
        self._take(stretches)

    def _take(self, stretches: list[tuple[int, int]]) -> None:
        both = sorted({*stretches, (self.total, self.total)})
        self.low, self.high = [a for a, _ in both], [b for _, b in both]

    def at_most(self, x: int) -> tuple[int, int]:
        """Least and greatest possible value of the last border not after ``x``."""
        i = bisect_right(self.low, x) - 1
        return (self.high[i], self.high[i]) if self.high[i] <= x else (self.low[i], x)

    def at_least(self, x: int) -> tuple[int, int]:
        """Least and greatest possible value of the first border not before ``x``."""
        i = min(bisect_left(self.high, x), len(self.high) - 1)
        return (self.low[i], self.low[i]) if self.low[i] >= x else (x, self.high[i])

    def doubtful(self, ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
        """The stretches with unknown inner borders that meet one of ``ranges``."""
        met = set()
        for a, b in ranges:
            for i in range(bisect_left(self.high, a), bisect_right(self.low, b)):
                if self.low[i] < self.high[i]:
                    met.add((self.low[i], self.high[i]))
        return sorted(met)

    def refine(self, old: list[tuple[int, int]], new: list[tuple[int, int]]) -> None:
        self._take([*set(zip(self.low, self.high)).difference(old), *new])


def _walk(borders: Borders, capacity: int, shards: int, side: int) -> list[int]:
    """Greedy cuts under ``capacity``; ``side`` 0 takes the least possible ones, 1 the greatest."""
    cuts = [0]
    for _ in range(shards):
        cuts.append(borders.at_most(cuts[-1] + capacity)[side])
    return cuts


def _smallest(borders: Borders, shards: int, side: int) -> int:
    """Smallest capacity whose walk reaches the end, by binary search."""
    low, high = -(-borders.total // shards), borders.total
    while low < high:
        middle = (low + high) // 2
        if _walk(borders, middle, shards, side)[-1] >= borders.total:
            high = middle
        else:
            low = middle + 1
    return low


def _cuts(borders: Borders, capacity: int, shards: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Starts of the shards 1, 2, … under ``capacity``, and the ranges in doubt (none: exact)."""
    doubt: list[tuple[int, int]] = []

    def known(answer: tuple[int, int]) -> int:
        if answer[0] < answer[1]:
            doubt.append(answer)
        return answer[1]

    latest = [borders.total]  # from the last shard back: where it must have begun at the latest need
    for _ in range(shards - 1):
        latest.append(known(borders.at_least(max(0, latest[-1] - capacity))))
    cuts = [0]
    for k in range(1, shards):
        here, rest = cuts[-1], borders.total - cuts[-1]
        share = known(borders.at_most(here - (-rest // (shards - k + 1))))
        if share <= here < borders.total:  # a group above the share is taken whole
            share = known(borders.at_least(here + 1))
        cuts.append(min(borders.total, max(share, latest[shards - k])))
    return cuts[1:], doubt


def _stretches(starts: DataFrame, ranges: list[tuple[int, int]], cells: int, widest: int) -> list[tuple[int, int]]:
    """First and last start in each of about ``cells`` equal cells of the ranges."""
    merged: list[list[int]] = []
    for a, b in ranges:
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    span = sum(b - a + 1 for a, b in merged)
    width = max(1, min(-(-span // cells), widest))
    at, cell, inside, first = F.col("at"), F.lit(None).cast("long"), F.lit(False), 0
    for a, b in merged:
        here = at.between(a, b)
        inside = inside | here
        cell = F.when(here, F.floor((at - a) / width) + first).otherwise(cell)
        first += (b - a) // width + 1
    found = starts.where(inside).groupBy(cell.alias("cell")).agg(F.min("at").alias("low"), F.max("at").alias("high"))
    return [(r["low"], r["high"]) for r in found.select("low", "high").collect()]


def find_cuts(starts: DataFrame, total: int, shards: int = SHARDS, cells: int = CELLS) -> list[int]:
    """Exact starts of the shards 1, 2, … for group starts in column `at` (long, from 0)."""
    borders = Borders(_stretches(starts, [(0, total)], cells, total), total)
    while True:
        low, high = (_smallest(borders, shards, side) for side in (1, 0))
        if low == high:
            cuts, ranges = _cuts(borders, low, shards)
        else:
            cuts, ranges = [], list(zip(_walk(borders, low, shards, 0), _walk(borders, high, shards, 1)))
        old = borders.doubtful(ranges)
        if not old:
            return cuts
        # Finer than before even if many stretches are in doubt, so this comes to an end.
        halved = max(1, max(b - a for a, b in old) // 2)
        borders.refine(old, _stretches(starts, old, cells, halved))


def _measured(docs: DataFrame, carry: Sequence[str], overhead: int) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"),
        F.col("doc_id").alias("id"),
        F.monotonically_increasing_id().alias("tie"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def in_order(docs: DataFrame, carry: Sequence[str] = ("doc_id",), overhead: int = OVERHEAD) -> DataFrame:
    """Every document in the order of its text's digest: `at` bytes and `number` rows are before it.

    `opens` says that a group begins with the row. Staged.
    """
    order = ["digest", "id", "tie"]
    measured = stage(_measured(docs, carry, overhead), "shard-sizes")
    ranged = measured.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stage(
        ranged.select(
            "row", "size", "text_crc32", "digest",
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        ),
        "shard-order",
    )
    # One row per partition of the order.
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = held.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("digest").alias("last"))
    parts = parts.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows"),
        F.last("last").over(earlier).alias("last"),
    )
    inside = W.partitionBy("part").orderBy("place")
    before = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1))
    previous = F.coalesce(F.lag("digest").over(inside), F.col("last"))
    placed = held.join(F.broadcast(parts), "part").select(
        "row",
        "size",
        "text_crc32",
        (F.col("bytes") + F.coalesce(before, F.lit(0))).alias("at"),
        (F.col("rows") + F.row_number().over(inside) - 1).alias("number"),
        (~F.col("digest").eqNullSafe(previous)).alias("opens"),
    )
    return stage(placed, "shard-places")


def _steps(at: Column, places: Sequence[int], values: Sequence[int]) -> Column:
    """The value of the last place not after ``at`` (places rise, the first is 0)."""
    out = F.lit(values[0]).cast("long")
    for place, value in zip(places[1:], values[1:]):
        out = F.when(at >= place, F.lit(value).cast("long")).otherwise(out)
    return out


def shard(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
    cells: int = CELLS,
) -> DataFrame:
    """The carried columns of every document with size, text_crc32, law, shard, slot, grown_shard.

    `slot` numbers the rows of a shard from 0; `grown_shard` is null, as the law is `bytes`.
    """
    rows = in_order(docs, carry, overhead)
    total = rows.agg(F.sum(F.col("size"))).first()[0]
    places, numbers, names = [0], [0], [0]
    if total is not None:
        cuts = find_cuts(rows.where("opens").select("at"), total, shards, cells)
        wanted = {c: n for n, c in enumerate(cuts, 1) if c < total}  # of empty shards none has a row
        first = rows.where(F.col("opens") & F.col("at").isin(*wanted)).select("at", "number") if wanted else rows.limit(0)
        for at, number in sorted((r["at"], r["number"]) for r in first.collect()):
            places.append(at)
            numbers.append(number)
            names.append(wanted[at])
    at = F.col("at")
    kept = [c for c in carry if c not in RESULT]
    return rows.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        _steps(at, places, names).cast("int").alias("shard"),
        (F.col("number") - _steps(at, places, numbers)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
