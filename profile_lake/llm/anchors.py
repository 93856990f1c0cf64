"""Equal windows of texts, found from sampled positions.

The anchor of a window is its leftmost gram (a short stretch) of least fingerprint, so
equal windows have equal anchors at equal places. The windows of a text that share an
anchor follow one another and make a segment; equal segments that follow one another, as
in text that repeats itself, make one row. Rounds of naming then settle which windows are
repeats:

1. segments are sorted by (anchor name, segment name, place): an anchor seen once has
   only unique windows and leaves; a segment equal to an earlier one is a repeat whole;
2. of anchors with several different segments, each different segment is taken apart,
   once, into its windows: their names are sorted with their places, and all but a name's
   first place are repeats.

Names are fingerprints modulo a prime in two lanes: 122 bits decide between windows, 93
between segments of one anchor. Texts themselves are not compared. Every round's result
is written to the shared folder, so lost executors repeat one round at most, and no round
holds a group in memory: groups are sorted, and only neighbours are compared.
"""

from __future__ import annotations

import gc
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profile_lake.llm.batches import BASES, Rolling, Words, map_texts, text_bytes, window_starts
from profile_lake.session import stage

#: Stands for a null doc_id; it sorts before all others, as null does.
NO_ID = -(1 << 63)


def settled(df: DataFrame, label: str, large: bool = False) -> DataFrame:
    """Write a round's result and let Spark drop the shuffle files that led to it.

    Spark drops them once its driver has collected the plan as garbage. After a ``large``
    round that is asked for twice: what the first collection finds is released after it.
    """
    out = stage(df, label)
    for _ in range(2 if large else 1):
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        if large:
            time.sleep(0.5)
    return out


def keyed_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) of every row, no two of one doc, and the doc_id of each doc.

    Where ids tell rows apart, doc is the id (:data:`NO_ID` for null) and the second table
    is None. Else rows are numbered in the order of (doc_id, null first, MD5 of the text);
    which of rows equal in both comes first makes no difference but for their numbers.
    """
    own = F.col("doc_id").cast("long")
    text = F.coalesce("text", F.lit("")).alias("text")
    again = docs.groupBy(F.coalesce(own, F.lit(NO_ID)).alias("id")).count().filter("count > 1")
    if stage(again, "repeated-ids").isEmpty():
        return docs.select(F.coalesce(own, F.lit(NO_ID)).alias("doc"), text), None
    # Written once each: a row has the same number wherever it is read.
    rows = settled(docs.select(F.monotonically_increasing_id().alias("row"), own.alias("doc_id"), text), "rows")
    # Numbers grow from partition to partition, and these are in the sort's order.
    order = rows.select("row", "doc_id", F.md5("text").alias("key")).orderBy("doc_id", "key", "row")
    ids = settled(order.select("row", "doc_id", F.monotonically_increasing_id().alias("doc")), "row-order")
    keyed = rows.select("row", "text").join(ids.select("row", "doc").hint("shuffle_hash"), "row")
    return settled(keyed.select("doc", "text"), "keyed-rows"), ids.select("doc", "doc_id")


def named(df: DataFrame, ids: DataFrame | None, column: str = "doc", name: str = "doc_id") -> DataFrame:
    """``column``, a doc of :func:`keyed_rows`, replaced by its doc_id."""
    if ids is None:
        return df.withColumn(name, F.when(F.col(column) != NO_ID, F.col(column))).drop(column)
    other = ids.select(F.col("doc").alias("its_doc"), F.col("doc_id").alias(name))
    return df.join(other, F.col(column) == F.col("its_doc")).drop(column, "its_doc")


def leftmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """Of every window of ``size`` values, the place of the first least one."""
    place, least, span = np.arange(len(values)), values, 1
    while span < size:
        step = min(span, size - span)
        if len(least) <= step:
            return place[:0]
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        span += step
    return place


@dataclass(frozen=True)
class Units:
    """What a text is a sequence of: bytes, or words cut at ``separators``."""

    window: int
    gram: int
    separators: bytes | None = None

    def read(self, texts: pa.Array) -> tuple[Rolling, Rolling, np.ndarray]:
        """The units in both lanes of fingerprints, and where each text's begin."""
        if self.separators is None:
            data, begin = text_bytes(texts)
            return Rolling(data, BASES[0]), Rolling(data, BASES[1]), begin
        words = Words(texts, self.separators)
        one, two = (Rolling(words.hashes(base), base) for base in BASES)
        return one, two, words.first

    def segments(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Runs of equal segments: text, first and last window start within it, windows of
        each segment, anchor name, segment name and 32 more bits of it."""
        one, two, first = self.read(texts)
        starts = window_starts(first, self.window)
        grams = one.windows(self.gram)
        anchor = leftmost_least(grams, self.window - self.gram + 1)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(new)
        low = starts[begin]
        high = starts[np.append(begin[1:], len(starts))[: len(begin)] - 1]
        text = np.searchsorted(first, low, "right") - 1
        # Texts without units share their beginning with the next one.
        base = first[text]
        name = two.of(low, high + self.window)
        more = one.of(low, high + self.window) >> np.uint64(32)
        key = grams[anchor[begin]]
        run = np.ones(len(low), bool)
        run[1:] = (
            (text[1:] != text[:-1])
            | (low[1:] != high[:-1] + 1)
            | (key[1:] != key[:-1])
            | (name[1:] != name[:-1])
            | (more[1:] != more[:-1])
        )
        at = np.flatnonzero(run)
        last = np.append(at[1:], len(low))[: len(at)] - 1
        return text[at], (low - base)[at], (high - base)[last], (high - low + 1)[at], key[at], name[at], more[at]


def _segment_rows(docs: DataFrame, units: Units) -> DataFrame:
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        text, low, high, each, anchor, name, more = units.segments(part.column(1))
        columns = [
            part.column(0).take(pa.array(text)),
            pa.array((low << 32) + high),
            pa.array((each << 32) + more.astype(np.int64)),
            pa.array(anchor.view(np.int64)),
            pa.array(name.view(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc", "place", "each", "anchor", "name"])

    # Two numbers share a column: a shuffled row has eight bytes for each. Of `each` the
    # lower half belongs to the name.
    return map_texts(docs, work, "doc long, place long, each long, anchor long, name long")


def _windows_of(docs: DataFrame, segments: DataFrame, units: Units) -> DataFrame:
    """One row per window of the given segments: its name in both lanes and its place."""
    lists = segments.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("segments"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        first_lane, second_lane, first = units.read(part.column(1))
        own = part.column(2)
        inner = own.flatten()
        low, high = (inner.field(i).to_numpy().astype(np.int64) for i in (0, 1))
        row = np.repeat(np.arange(len(own)), np.diff(np.asarray(own.offsets)))
        sizes = high - low + 1
        row = np.repeat(row, sizes)
        start = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        begin = start + first[row]
        one, two = (lane.of(begin, begin + units.window) for lane in (first_lane, second_lane))
        columns = [
            pa.array(one.view(np.int64)),
            pa.array(two.view(np.int64)),
            part.column(0).take(pa.array(row)),
            pa.array(start.astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["one", "two", "doc", "low"])

    joined = docs.join(lists.hint("shuffle_hash"), "doc").select("doc", "text", "segments")
    return map_texts(joined, work, "one long, two long, doc long, low int")


def repeated_windows(docs: DataFrame, units: Units, across: bool) -> DataFrame:
    """Runs of window starts (doc, low, high) that repeat an earlier window.

    Earlier is a smaller doc, or also the same doc at a smaller start; only a smaller doc
    if ``across``. ``docs`` has one row per doc.
    """
    in_order = W.partitionBy("anchor", "name", "more_name").orderBy("doc", "place")
    own = ["doc"] if across else ["doc", "place"]
    first = F.first(F.struct(*own)).over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))
    names = W.partitionBy("anchor")
    low, high = F.shiftright("place", 32).cast("int"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
    differ = [F.min(name).over(names) != F.max(name).over(names) for name in ("name", "more_name")]
    several_in_run = F.lit(False) if across else high - low >= F.col("each")
    rows = (
        _segment_rows(docs, units)
        .repartition("anchor")
        .withColumn("more_name", F.col("each").bitwiseAND(0xFFFFFFFF))
        .withColumn("each", F.shiftright("each", 32).cast("int"))
        .withColumn("repeat", first != F.struct(*own))
        .withColumn("several", differ[0] | differ[1])
        .select("doc", low.alias("low"), high.alias("high"), "each", "repeat", "several", several_in_run.alias("more"))
        .filter("repeat OR several OR more")
    )
    rows = settled(rows, "segments", large=True)
    fresh = rows.filter("NOT repeat")
    # Within a document all but the first segment of a run repeat the first.
    later = fresh.filter("more").select("doc", (F.col("low") + F.col("each")).alias("low"), "high")
    end = F.col("high") if across else F.col("low") + F.col("each") - 1
    apart = _windows_of(docs, fresh.filter("several").select("doc", "low", end.alias("high")), units)
    own = ["doc"] if across else ["doc", "low"]
    pairs = W.partitionBy("one", "two").orderBy("doc", "low").rowsBetween(W.unboundedPreceding, W.currentRow)
    single = (
        apart.withColumn("repeat", F.first(F.struct(*own)).over(pairs) != F.struct(*own))
        .filter("repeat")
        .select("doc", "low", F.col("low").alias("high"))
    )
    return rows.filter("repeat").select("doc", "low", "high").unionByName(later).unionByName(settled(single, "windows", large=True))


def with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """doc, text and the doc's runs (an empty array if it has none)."""
    lists = runs.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    none = F.array().cast("array<struct<low:int,high:int>>")
    joined = docs.join(lists.hint("shuffle_hash"), "doc", "left")
    return joined.select("doc", "text", F.coalesce("runs", none).alias("runs"))


def removed_units(runs: pa.Array, first: np.ndarray, window: int) -> np.ndarray:
    """Which units of a slice of texts lie in a window of their text's runs."""
    inner = runs.flatten()
    low, high = (inner.field(i).to_numpy().astype(np.int64) for i in (0, 1))
    base = np.repeat(first[:-1], np.diff(np.asarray(runs.offsets)))
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(edge, base + low, 1)
    np.add.at(edge, base + high + window, -1)
    return np.cumsum(edge[:-1]) > 0


def digests(rows: DataFrame, ids: DataFrame | None, runs: DataFrame, digest, schema: str) -> DataFrame:
    """doc_id and ``digest`` (a slice's texts and runs -> columns of ``schema``) of every row."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        names = ["doc", *[x.split()[0] for x in schema.split(", ")]]
        return pa.RecordBatch.from_arrays([part.column(0), *digest(part.column(1), part.column(2))], names)

    found = named(map_texts(with_runs(rows, runs), work, f"doc long, {schema}"), ids)
    return found.select("doc_id", *[x.split()[0] for x in schema.split(", ")])
