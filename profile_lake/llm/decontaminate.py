"""Benchmark decontamination with DataFrame functions only.

Items become a set of normalised word windows (the whole item if it is shorter), held
with a 64-bit hash each. Every window of every training text is hashed and looked up;
words decide whether a hit is real. Each document also looks up its empty window, which
is in the set, so documents without hits stay in the one pass over the texts.

The set is broadcast only if its measured size is at most :data:`BROADCAST_BYTES`. Beyond
that the windows' hashes and places are shuffled, not the texts: each document meets what
was found for it once, and is verified there.

Null text: no words. Items without words are no items; a null item_id hits but is not
listed. Repeated rows: each gets its result. Empty tables: no hits. Other columns and
their names do not matter: only doc_id and text (item_id and text) are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profile_lake.session import stage

WINDOW = 10
BROADCAST_BYTES = 64 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """ASCII letters lower-cased; words are runs of digits, letters and non-ASCII characters."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def window_key(words: Column) -> Column:
    return F.xxhash64(words)


def windows(words: Column, size: int) -> Column:
    """Start, size and key of every window of ``size`` words."""
    last = F.size(words) - size
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.struct(
                i.alias("start"), F.lit(size).alias("size"), window_key(F.slice(words, i + 1, size)).alias("key")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<start:int,size:int,key:bigint>>"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The set of windows: key, words, and the items that have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    size = F.least(F.size("words"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(0), F.size("words") - size))
    return (
        items.filter(F.size("words") > 0)
        .select("item_id", "words", starts.alias("start"))
        .select("item_id", F.slice("words", F.col("start") + 1, size).alias("words"))
        .groupBy("words")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(window_key(F.col("words")).alias("key"), F.col("words").alias("item_words"), "items")
    )


def _with_empty_window(items: DataFrame) -> DataFrame:
    spark = items.sparkSession
    nothing = F.array().cast("array<string>")
    return items.unionByName(
        spark.range(1).select(
            window_key(nothing).alias("key"), nothing.alias("item_words"), nothing.alias("items")
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[Column] | None = None):
    """The kept columns (doc_id), n_words, hit spans and hit items of every document.

    Spans are {start, end} in words, end exclusive, sorted; items are sorted strings.
    """
    items = stage(item_windows(benchmark, window), "item-windows")
    measure = F.sum(F.length(F.array_join("item_words", " ")) + F.length(F.array_join("items", " ")) + 64)
    held, sizes = items.agg(measure, F.collect_set(F.size("item_words"))).first()  # a number and at most `window` sizes
    keep = keep or [F.col("doc_id").cast("long").alias("doc_id")]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("kept"), words_of(F.col("text")).alias("words")
    )
    if (held or 0) > BROADCAST_BYTES:
        return _shuffled(rows, items, sorted(sizes))
    wanted = F.broadcast(_with_empty_window(items))
    empty = F.struct(
        F.lit(-1).alias("start"), F.lit(0).alias("size"), window_key(F.array().cast("array<string>")).alias("key")
    )
    looked_up = F.concat(F.array(empty), *[windows(F.col("words"), size) for size in sorted(sizes or [])])
    hits = (
        rows.select("row", "kept", "words", F.explode(looked_up).alias("w"))
        .select("row", "kept", "words", "w.start", "w.size", "w.key")
        .join(wanted, "key")
        .filter(F.slice("words", F.greatest("start", F.lit(0)) + 1, F.col("size")) == F.col("item_words"))
        .select(
            "row",
            F.when(F.col("start") < 0, F.struct("kept", F.size("words").cast("long").alias("n_words"))).alias("document"),
            F.when(F.col("start") >= 0, F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("span"),
            "items",
        )
    )
    return (
        hits.groupBy("row")
        .agg(
            F.first("document", ignorenulls=True).alias("document"),
            F.array_sort(F.collect_set("span")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select("document.kept.*", "document.n_words", "spans", "items")
    )


def _shuffled(rows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Result of :func:`contamination` for a set of windows that is not broadcast."""
    rows = stage(rows, "numbered")  # the row numbers are used twice
    places = F.concat(*[windows(F.col("words"), size) for size in sizes])
    found = (
        rows.select("row", F.explode(places).alias("w"))
        .select("row", "w.start", "w.size", "w.key")
        .join(items, "key")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "size", "item_words", "items")).alias("found"))
    )
    real = F.filter("found", lambda h: F.slice("words", h["start"] + 1, h["size"]) == h["item_words"])
    checked = rows.join(found, "row", "left").select("kept", "words", F.coalesce(real, F.array()).alias("hits"))
    spans = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), (h["start"] + h["size"]).alias("end")))
    return checked.select(
        "kept.*",
        F.size("words").cast("long").alias("n_words"),
        F.array_sort(F.array_distinct(spans)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))).alias("items"),
    )


def covered_words(spans: Column) -> Column:
    """How many words the sorted spans cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], s["end"]).alias("reach"),
        ),
        lambda acc: acc["n"],
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of an item; all columns pass unchanged."""
    same = ["doc_id", F.md5("text").alias("text_key")]
    hit = contamination(docs, benchmark, window, [F.col("doc_id"), same[1]])
    hit = hit.filter(F.size("spans") > 0).select(F.col("doc_id").alias("hit_id"), "text_key").distinct()
    keyed = docs.select(F.struct("*").alias("row"), *same)
    match = keyed["doc_id"].eqNullSafe(hit["hit_id"]) & (keyed["text_key"] == hit["text_key"])
    return keyed.join(hit, match, "left_anti").select("row.*")
