"""Groups of spelling variants among the words of a corpus.

Two words are near if exactly one code point is inserted, deleted or replaced between
them. A word's form is its near word with the largest count if that is at least twice its
own; following forms leads to the word's root.

Of two near words one half of each is the same. So every word is sent to the blocks of its
possible halves, a few thousand words each; a block builds a bidirectional FM-index over
its delimited vocabulary and searches it with the words that ask there: one half exactly,
then across the other with one error (:mod:`fm_index`). A half shared by more words than a
block should hold is split by word; all words that ask for it ask in each part.

Words are maximal runs of `[A-Za-z\\u00C0-\\u00FF]` with A-Z lower-cased; those of fewer than
``least_length`` code points or ``least_count`` occurrences are no words. Counts are summed per
task before they are shuffled. Null and empty texts have no words; a null doc_id is an
empty string in the hash that decides where a letter is dropped. Repeated rows count each
time; ties between forms go to the word that is first in code-point order. Other columns
of ``docs`` are never read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profile_lake.llm.batches import bound_batches, slices
from profile_lake.llm.fm_index import BidirectionalIndex, one_error
from profile_lake.session import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: One occurrence hash in so many drops a code point.
DROP_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Words a block holds on average, and about the words a task counts before it sends them.
BLOCK_WORDS = 8192
HELD_WORDS = 200_000
#: Symbols of queries searched together, padding included.
SEARCHED = 1 << 15


def variant(doc_id: int | None, run: str) -> str:
    """A lower-cased run as it counts: in one of 97 cases without one code point."""
    place = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if place % DROP_EVERY:
        return run
    at = place % len(run)
    return run[:at] + run[at + 1 :]


def counted_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts."""

    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for own, n in Counter(RUN.findall(text)).items():
                        word = variant(doc_id, own.translate(LOWER))
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield sent(counts)
                    counts = Counter()
        yield sent(counts)

    bound_batches(docs)
    rows = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halves() -> Column:
    """Every half by which a near word may ask for a word, and whether the word asks by it.

    A query of m code points has m / 2, rounded down, in its left half; a word's length
    differs from that of a near query by one at most.
    """
    length = F.length("word")

    def of_side(side: int) -> Column:
        rounded = F.floor if side == 0 else F.ceil
        sizes = F.array_distinct(F.array(*[rounded((length + d) / 2).cast("int") for d in (-1, 0, 1)]))
        asks = lambda size: size == rounded(length / 2)
        first = lambda size: F.lit(1) if side == 0 else length - size + 1
        return F.transform(
            sizes,
            lambda size: F.struct(
                F.lit(side).alias("side"), F.substring("word", first(size), size).alias("half"), asks(size).alias("asks")
            ),
        )

    return F.concat(of_side(0), of_side(1))


def _blocks(words: DataFrame, block_words: int) -> DataFrame:
    """Rows (block, side, word, n, holds, asks): what a block's index holds and who asks there."""
    rows = words.select("word", "n", F.explode(_halves()).alias("h")).select("word", "n", "h.*")
    total = 4 * words.count()
    blocks = max(1, -(-total // block_words))
    shared = rows.groupBy("side", "half").count().where(F.col("count") > block_words)
    shared = shared.select("side", "half", F.ceil(F.col("count") / block_words).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    to = F.when(F.col("asks"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(own))
    spread = rows.join(shared, ["side", "half"], "left").select(
        "side", "half", "word", "n", "asks", own.alias("own"), F.explode(to).alias("part")
    )
    block = F.pmod(F.xxhash64("half", "part"), F.lit(blocks))
    return spread.select(block.alias("block"), "side", "word", "n", (F.col("part") == F.col("own")).alias("holds"), "asks")


def _symbols(words: list[str]) -> tuple[list[np.ndarray], int]:
    """Words as arrays of symbols 1, 2, … in code-point order, and the number of symbols with 0."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters, symbol = np.unique(points, return_inverse=True)
    ends = np.cumsum([len(w) for w in words])
    return np.split((symbol + 1).astype(np.int16), ends[:-1]), len(letters) + 1


def _chunks(queries: list[int], words: list[np.ndarray]) -> Iterator[list[int]]:
    """Queries by length, so many at once that their padded symbols stay below a bound."""
    queries = sorted(queries, key=lambda i: len(words[i]))
    first = 0
    while first < len(queries):
        last = first + 1
        while last < len(queries) and (last - first + 1) * len(words[queries[last]]) <= SEARCHED:
            last += 1
        yield queries[first:last]
        first = last


def _search_block(table: pa.Table) -> pa.Table:
    """(word, near, near_n) of a block's asking words; a pair may come twice."""
    flat = zip(*[table.column(c).to_pylist() for c in ("word", "n", "holds", "asks")])
    count, held, asking = {}, set(), set()
    for word, n, holds, asks in flat:
        count[word] = n
        if holds:
            held.add(word)
        if asks:
            asking.add(word)
    words = sorted(count)
    arrays, size = _symbols(words)
    holders = [i for i, w in enumerate(words) if w in held]
    left, right = [], []
    if holders:
        index = BidirectionalIndex([arrays[i] for i in holders], size)
        leftwards = table.column("side")[0].as_py() == 1
        for chunk in _chunks([i for i, w in enumerate(words) if w in asking], arrays):
            query, word = one_error(index, [arrays[i] for i in chunk], leftwards)
            for q, w in set(zip(query.tolist(), word.tolist())):
                left.append(words[chunk[q]])
                right.append(words[holders[w]])
    return pa.table({
        "word": pa.array(left, pa.string()),
        "near": pa.array(right, pa.string()),
        "near_n": pa.array([count[w] for w in right], pa.int64()),
    })


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every pair (word, near, near_n) of near words, in both directions, once."""
    found = _blocks(words, block_words).groupBy("block", "side").applyInArrow(
        _search_block, "word string, near string, near_n long"
    )
    return found.repartition("word").groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root): where the forms of every word lead.

    Each round steps from the words whose root is known to those of which they are the
    form. Counts double along a chain, so there are fewer rounds than bits in a count.
    """
    known = stage(formed.where("form IS NULL").select("word", F.col("word").alias("root")), "spelling-roots")
    pointing = formed.where("form IS NOT NULL").select("word", "form")
    parts = [known]
    while not known.isEmpty():
        of_form = known.select(F.col("word").alias("form"), "root")
        known = stage(pointing.join(of_form, "form").select("word", "root"), "spelling-roots")
        parts.append(known)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def forms(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of distinct words with their counts (word, n)."""
    words = stage(words, "spelling-words")
    best = near_words(words, block_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    often = -F.col("best.less")
    strong = often >= 2 * F.col("n")
    formed = stage(
        words.join(best, "word", "left").select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, often).alias("form_n"),
        ),
        "spelling-forms",
    )
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
