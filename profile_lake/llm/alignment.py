"""Alignment of two tokenizers over a corpus, and how often their tokens end together.

A text's tokens by A (a byte-level BPE, on a space and the text) and by B (a sentencepiece
BPE, which adds the space itself) cover the same bytes. Where tokens of both end, a group
ends, and its last two tokens are linked. A pair's count is its number of links in the
whole corpus.

Pass one encodes and aligns the texts, once: their tokens are staged with a mark where groups
end (:class:`Codes`). Links are read from there and summed by pair within each task. The
distinct pairs are dealt to segments of bounded size and numbered by a minimal perfect hash
(:mod:`pair_table`). Per segment and branch (sixteen branches of tasks) the counts become a
dense vector indexed by that number; vectors are added up in a tree, four at a time. Pass
two reads the staged tokens again and looks the counts up, each key verified. It gets at most
:data:`TABLE_PAIRS` pairs at once, a bounded broadcast; with more pairs than that, links
are staged and filled in by one round for each such part of the table.

Both tokenizers work on pieces of text: no token of either goes from a printable character
to a following space, so a text is cut there and equal pieces of a slice are encoded once.
A vocabulary of B with a token across such a border is recognised, and texts stay whole.
Pieces of Latin-1 letters and printable ASCII are encoded in one call, those of A by
tiktoken if the file's merges are in the order of its ids; all others by the two libraries
of the files, piece by piece.

Null and empty texts have no tokens, nor have texts whose tokens do not spell a space and
the text (B's vocabulary writes a space as U+2581, so a text with that character is one).
Repeated rows and ids are ordinary rows and count each time. Other columns are never read.
An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profile_lake.llm.batches import bound_batches, give_back, map_texts, per_text, slices, text_bytes
from profile_lake.llm.pair_table import SPREAD_BITS, PairTable, Segment, build, spread
from profile_lake.session import stage

SEGMENT_PAIRS = 1 << 15
TABLE_PAIRS = 1 << 21
BRANCHES, FAN_IN = 16, 4
#: Plain pieces B encodes at once: its time grows faster than a text's length.
JOINED_PIECES = 64
#: Bytes of texts whose pieces are encoded together, and of staged tokens read together.
SLICE_BYTES = 1 << 21
#: Pairs a task adds up before it sends them.
HELD_PAIRS = 1 << 19

_BORDER = re.compile("(?<=[!-~À-ÿ])(?= +[^ ])")
_PLAIN = re.compile("[ -~À-ÿ]*[!-~À-ÿ]")
LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("best", pa.bool_())])
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, groups string, links array<struct<a:int,b:int,n:bigint,best:boolean>>"
)


def _bytes_of_symbols() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in order for the
    characters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _is_plain(piece: str) -> bool:
    if piece.isascii() and piece.isprintable():
        return piece[-1] != " "
    return _PLAIN.fullmatch(piece) is not None


@dataclass(frozen=True)
class Codes:
    """Tokens as 32-bit numbers that also tell where groups end.

    A text's tokens stand group by group, those of A first. Id a of A is 2a, the last of its
    group 2a + 1. Ids of B follow all of A's: 3b, the last of its group 3b + 1, the last of
    its text 3b + 2.
    """

    n_a: int
    n_b: int

    def of_a(self, codes: np.ndarray) -> np.ndarray:
        return codes < 2 * self.n_a

    def pairs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the groups' last codes, and the pairs linked there."""
        of_a, of_b = _ends(self.n_a, self.n_b)
        at = np.flatnonzero(of_b[codes])
        a, b = codes[of_a[codes]].astype(np.int64) >> 1, (codes[at].astype(np.int64) - 2 * self.n_a) // 3
        return at, a * self.n_b + b

    def groups(self, codes: np.ndarray, begin: np.ndarray) -> pa.Array:
        """Every text's groups as text."""
        printed = _printed(self.n_a, self.n_b).take(pa.array(codes))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), printed), "")


@lru_cache(maxsize=1)
def _ends(n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every code, whether it ends a group's tokens of A, and whether those of B."""
    of_a, of_b = np.zeros((2, 2 * n_a + 3 * n_b), bool)
    of_a[1 : 2 * n_a : 2] = True
    of_b[2 * n_a :] = np.arange(3 * n_b) % 3 > 0
    return of_a, of_b


@lru_cache(maxsize=1)
def _printed(n_a: int, n_b: int) -> pa.Array:
    """Every code as it is written in groups."""
    of_a, of_b = [(i, e) for i in range(n_a) for e in ",|"], [(i, e) for i in range(n_b) for e in (",", ";", "")]
    return pa.array([f"{i}{end}" for i, end in of_a + of_b])


class Encoded:
    """Distinct pieces of a slice, aligned: all their codes, and where each piece's begin.

    ``right`` says of which pieces the tokens spell the piece; the others have none.
    """

    def __init__(self, a_ids: np.ndarray, b_ids: np.ndarray, sizes: np.ndarray, right: np.ndarray, aligner: Aligner):
        ends = np.cumsum(np.where(right, sizes, 0))
        a_end = np.cumsum(aligner.a_size[a_ids])
        b_end = np.cumsum(aligner.b_size[b_ids])
        at = np.searchsorted(b_end, a_end)
        together = b_end[at] == a_end if len(a_end) else np.zeros(0, bool)
        n_a, n_b, last_b = len(a_ids), len(b_ids), at[together]
        ends_a, ends_b = together.astype(np.int64), np.zeros(n_b, np.int64)
        ends_b[last_b] = 1
        # A group's tokens of A, then those of B.
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        codes = np.empty(n_a + n_b, np.int32)
        codes[np.arange(n_a) + np.concatenate([[0], last_b + 1])[group_a]] = 2 * a_ids + ends_a
        codes[np.arange(n_b) + (np.flatnonzero(together) + 1)[group_b]] = 2 * aligner.codes.n_a + 3 * b_ids + ends_b
        self.right, self.codes = right, codes
        self.first = sum(np.concatenate([[0], np.searchsorted(e, ends, "right")]) for e in (a_end, b_end))


class Aligner:
    """Both tokenizers, made from the contents of their files."""

    def __init__(self, a_file: bytes, b_file: bytes, a_pattern: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_buffer(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        symbol = _bytes_of_symbols()
        model = json.loads(a_file)["model"]
        self.a_bytes = [b""] * (max(model["vocab"].values()) + 1)
        for token, number in model["vocab"].items():
            # Special tokens are not spelled in symbols; no text is encoded to one.
            self.a_bytes[number] = bytes(symbol[c] for c in token) if all(c in symbol for c in token) else b""
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.cuts = not any(re.search("[^▁]▁", n) for n in names)
        self.codes = Codes(len(self.a_bytes), len(names))
        self.quick = self._ranked(model, a_pattern)

    def _ranked(self, model: dict, pattern: str | None):
        """A as an encoding of tiktoken, if its ids are the ranks of its merges."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"].get("".join(m), -1) for m in merges]
        ranks = {token: number for number, token in enumerate(self.a_bytes) if token}
        single = [ranks.get(bytes([i]), len(ranks)) for i in range(256)]
        if pattern is None or order != sorted(set(order)) or not order or max(single) >= order[0]:
            return None
        import tiktoken

        return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, text: str) -> list[str]:
        whole = " " + text
        return _BORDER.split(whole) if self.cuts else [whole]

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Tokens of plain pieces, joined to longer texts; None if they do not spell them."""
        runs = ["".join(pieces[i : i + JOINED_PIECES]) for i in range(0, len(pieces), JOINED_PIECES)]
        whole = "".join(runs)
        a_ids = self.quick.encode_ordinary(whole) if self.quick else self.a.encode(whole, add_special_tokens=False).ids
        b_ids = list(chain.from_iterable(self.b.encode([r[1:] for r in runs], num_threads=1)))
        raw = whole.encode()
        if any(b"".join(map(table.__getitem__, ids)) != raw for table, ids in ((self.a_bytes, a_ids), (self.b_bytes, b_ids))):
            return None
        return np.array(a_ids, np.int64), np.array(b_ids, np.int64)

    def encoded(self, pieces: list[str]) -> tuple[np.ndarray, Encoded]:
        """Distinct pieces, each beginning with a space, aligned; and each piece's place there."""
        plain = [i for i, p in enumerate(pieces) if _is_plain(p)] if self.cuts else []
        ids = self._together([pieces[i] for i in plain]) if plain else None
        if ids is None:
            plain, ids = [], (np.zeros(0, np.int64), np.zeros(0, np.int64))
        place = np.empty(len(pieces), np.int64)
        apart = np.ones(len(pieces), bool)
        apart[plain] = False
        other = np.flatnonzero(apart)
        place[plain], place[other] = np.arange(len(plain)), np.arange(len(plain), len(pieces))
        texts = [pieces[i] for i in other.tolist()]
        a_other = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b_other = self.b.encode([t[1:] for t in texts], num_threads=1)
        right = np.ones(len(pieces), bool)
        for n, (text, a, b) in enumerate(zip(texts, a_other, b_other)):
            raw = text.encode()
            if any(b"".join(map(table.__getitem__, x)) != raw for table, x in ((self.a_bytes, a), (self.b_bytes, b))):
                a_other[n], b_other[n] = [], []
                right[len(plain) + n] = False
        a_ids, b_ids = (
            np.concatenate([own, *[np.array(x, np.int64) for x in more]]) for own, more in zip(ids, (a_other, b_other))
        )
        sizes = np.empty(len(pieces), np.int64)
        sizes[place] = pc.binary_length(pa.array(pieces, pa.string())).to_numpy()
        return place, Encoded(a_ids, b_ids, sizes, right, self)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All codes of a slice, and where each text's begin.

        Texts whose tokens do not spell them have none.
        """
        read, first = [], [0]
        for text in texts:
            if text:
                read += self.pieces(text)
            first.append(len(read))
        distinct = list(dict.fromkeys(read))
        place, pieces = self.encoded(distinct)
        number = dict(zip(distinct, place.tolist()))
        order, first = np.fromiter(map(number.__getitem__, read), np.int64, len(read)), np.array(first, np.int64)
        wrong = ~pieces.right[order]
        if wrong.any():
            text_of = np.repeat(np.arange(len(texts)), np.diff(first))
            good = np.bincount(text_of[wrong], minlength=len(texts)) == 0
            order = order[good[text_of]]
            first = np.concatenate([[0], np.cumsum(np.where(good, np.diff(first), 0))])
        many = np.diff(pieces.first)[order]
        begin = np.concatenate([[0], np.cumsum(many)])
        codes = pieces.codes[np.arange(begin[-1]) + np.repeat(pieces.first[order] - begin[:-1], many)]
        begin = begin[first]
        codes[begin[1:][np.diff(begin) > 0] - 1] += 1  # a text's end
        return codes, begin


@lru_cache(maxsize=1)
def _aligner(a_file: bytes, b_file: bytes, a_pattern: str | None) -> Aligner:
    return Aligner(a_file, b_file, a_pattern)


def _encoded(docs: DataFrame, files) -> DataFrame:
    """Pass one: (doc_id, codes) of every text. Staged."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        codes, begin = _aligner(*files.value).read(part.column(1).to_pylist())
        offsets = (begin * codes.itemsize).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(codes)])
        return pa.RecordBatch.from_arrays([part.column(0), packed], ["doc_id", "codes"])

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return stage(map_texts(texts, work, "doc_id long, codes binary", SLICE_BYTES), "align-codes")


def _codes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of some staged rows, and where each row's begin."""
    data, begin = text_bytes(column)
    return data.view(np.int32), begin // 4


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return distinct, total


def _link_counts(encoded: DataFrame, kinds: Codes) -> DataFrame:
    """(branch, spread, pair, n): each task's links, added up. Staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, held = [], [], 0

        def sent() -> pa.RecordBatch:
            distinct, total = _summed(pairs, counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(spread(distinct)), pa.array(distinct), pa.array(total)], ["spread", "pair", "n"]
            )

        for batch in batches:
            for part in slices(batch, "codes", SLICE_BYTES):
                found = pa.array(kinds.pairs(_codes_of(part.column(0))[0])[1]).value_counts()
                pairs.append(found.field(0).to_numpy())
                counts.append(found.field(1).to_numpy())
                held += len(found)
                if held > HELD_PAIRS:
                    distinct, total = _summed(pairs, counts)
                    pairs, counts, held = [distinct], [total], len(distinct)
                    if held > HELD_PAIRS // 2:
                        yield sent()
                        pairs, counts, held = [], [], 0
        if pairs:
            yield sent()
        give_back()

    bound_batches(encoded)
    rows = encoded.select("codes").mapInArrow(run, "spread long, pair long, n long")
    return stage(rows.withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(BRANCHES))), "align-counts")


def _numbered(table: pa.Table) -> pa.Table:
    """A segment's row: its pairs by number and the bitmaps that number them."""
    sizes, bits, keys = build(table.column("pair").to_numpy())
    return pa.table({
        "segment": pa.array([table.column("segment")[0].as_py()], pa.int64()),
        "sizes": pa.array([sizes.tobytes()], pa.binary()),
        "bits": pa.array([bits.tobytes()], pa.binary()),
        "keys": pa.array([keys.tobytes()], pa.binary()),
    })


SEGMENT = "segment long, sizes binary, bits binary, keys binary"


def _segment(row) -> Segment:
    return Segment(
        row["segment"],
        np.frombuffer(row["sizes"], np.int64),
        np.frombuffer(row["bits"], np.uint64),
        np.frombuffer(row["keys"], np.int64),
    )


def _dense(width: int):
    """A branch's counts of one segment as a vector indexed by the pairs' numbers."""

    def work(key: tuple[pa.Scalar, ...], counts: pa.Table, segments: pa.Table) -> pa.Table:
        own = PairTable([_segment(segments.slice(0, 1).to_pylist()[0])], width)
        vector = np.zeros(len(own.keys), np.int64)
        if counts.num_rows:
            vector[own.numbers(counts.column("pair").to_numpy())] = counts.column("n").to_numpy()
        return _vector(key[0].as_py(), key[1].as_py(), vector)

    return work


def _vector(segment: int, branch: int, vector: np.ndarray) -> pa.Table:
    return pa.table({
        "segment": pa.array([segment], pa.int64()),
        "branch": pa.array([branch], pa.int32()),
        "counts": pa.array([vector.tobytes()], pa.binary()),
    })


def _added(key: tuple[pa.Scalar, ...], vectors: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v, np.int64) for v in vectors.column("counts").to_pylist())
    return _vector(key[0].as_py(), key[1].as_py(), total)


def pair_counts(encoded: DataFrame, kinds: Codes, segment_pairs: int = SEGMENT_PAIRS) -> tuple[DataFrame, int, int]:
    """The numbered pairs with their counts by segment (staged), a segment's width, and the number of pairs."""
    counts = _link_counts(encoded, kinds)
    distinct = stage(counts.select("spread", "pair").distinct(), "align-pairs")
    n = distinct.count()
    # A power of two, so that segments are equal parts of the spread.
    width = (1 << SPREAD_BITS) >> min(SPREAD_BITS, max(0, (-(-n // segment_pairs) - 1).bit_length()))
    segment = F.floor(F.col("spread") / width).alias("segment")
    numbered = stage(distinct.select(segment, "pair").groupBy("segment").applyInArrow(_numbered, SEGMENT), "align-segments")
    leaves = counts.groupBy(segment, "branch", "pair").agg(F.sum("n").alias("n"))
    every = numbered.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1))))
    vectors = leaves.groupBy("segment", "branch").cogroup(every.groupBy("segment", "branch")).applyInArrow(
        _dense(width), "segment long, branch int, counts binary"
    )
    left = BRANCHES
    while left > 1:
        up = vectors.withColumn("branch", F.floor(F.col("branch") / FAN_IN).cast("int"))
        vectors = up.groupBy("segment", "branch").applyInArrow(_added, "segment long, branch int, counts binary")
        left = -(-left // FAN_IN)
    return stage(numbered.join(vectors.drop("branch"), "segment"), "align-table"), width, n


def _highest(table: DataFrame, n_b: int) -> np.ndarray:
    """Per id of B the highest count of its pairs; as many as B has ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(n_b, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.maximum.at(top, np.frombuffer(keys, np.int64) % n_b, np.frombuffer(counts, np.int64))
        seen = np.flatnonzero(top)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(top[seen])], ["b", "n"])

    rows = table.select("keys", "counts").mapInArrow(run, "b long, n long").groupBy("b").agg(F.max("n").alias("n"))
    top = np.zeros(n_b, np.int64)
    for r in rows.collect():
        top[r["b"]] = r["n"]
    return top


class Counts:
    """Counts of the pairs of some segments, and which are the highest of their id of B."""

    def __init__(self, table: PairTable, counts: np.ndarray, top: np.ndarray):
        self.table, self.counts = table, counts
        self.best = counts == top[table.keys % len(top)]

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pairs are in these segments, their counts and whether they are the best."""
        coded = pa.array(pairs).dictionary_encode()
        place, number = coded.indices.to_numpy(), self.table.numbers(coded.dictionary.to_numpy())
        known = number >= 0
        n, best = np.zeros(len(number), np.int64), np.zeros(len(number), bool)
        n[known], best[known] = self.counts[number[known]], self.best[number[known]]
        return known[place], n[place], best[place]


def _parts(table: DataFrame, width: int, top: np.ndarray, table_pairs: int, segment_pairs: int) -> Iterator[Counts]:
    """The table in parts of about ``table_pairs`` pairs."""
    each = max(1, table_pairs // segment_pairs)
    segments = (1 << SPREAD_BITS) // width
    for low in range(0, segments, each):
        rows = sorted(table.where(F.col("segment").between(low, low + each - 1)).collect(), key=lambda r: r["segment"])
        counts = [np.frombuffer(r["counts"], np.int64) for r in rows]
        yield Counts(PairTable([_segment(r) for r in rows], width), np.concatenate([np.zeros(0, np.int64), *counts]), top)


def _links(pairs: np.ndarray, n_b: int, n: np.ndarray, best: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array((pairs // n_b).astype(np.int32)), pa.array((pairs % n_b).astype(np.int32)), pa.array(n), pa.array(best)],
        fields=list(LINK),
    )


def _aligned(encoded: DataFrame, kinds: Codes, sent) -> DataFrame:
    """Pass two: groups and links of every text, counts from one part of the table."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        codes, begin = _codes_of(part.column(1))
        at, pairs = kinds.pairs(codes)
        first = np.searchsorted(at, begin)
        _, n, best = sent.value.of(pairs)
        n_a, n_links = per_text(kinds.of_a(codes), begin), np.diff(first)
        columns = [
            part.column(0),
            pa.array(n_a),
            pa.array(np.diff(begin) - n_a),
            pa.array(n_links),
            kinds.groups(codes, begin),
            pa.ListArray.from_arrays(pa.array(first, pa.int32()), _links(pairs, kinds.n_b, n, best)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "codes", SLICE_BYTES):
                yield work(part)
        give_back()

    return encoded.mapInArrow(run, RESULT)


def _filled(rows: DataFrame, n_b: int, sent) -> DataFrame:
    """Counts of one more part of the table, put into links that have none yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = batch.column("links")
            inner = links.flatten()
            pairs = inner.field(0).to_numpy().astype(np.int64) * n_b + inner.field(1).to_numpy()
            known, n, best = sent.value.of(pairs)
            n = np.where(known, n, inner.field(2).to_numpy())
            best = np.where(known, best, inner.field(3).to_numpy(zero_copy_only=False))
            ends = np.cumsum(pc.list_value_length(links).to_numpy())
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            filled = pa.ListArray.from_arrays(offsets, _links(pairs, n_b, n, best))
            yield batch.set_column(batch.schema.get_field_index("links"), "links", filled)

    return rows.mapInArrow(run, RESULT)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    a_pattern: str | None = None,
    table_pairs: int = TABLE_PAIRS,
    segment_pairs: int = SEGMENT_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups and links of every document.

    ``groups`` writes each group as A's ids, a bar and B's ids, groups parted by
    semicolons. ``links`` has each link's ids, its pair's count and whether no other pair
    of its B id has a higher one. The files are read here and sent to the tasks whole;
    ``a_pattern`` is the pattern by which A's library splits words, for tiktoken.
    """
    context = docs.sparkSession.sparkContext
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        contents = (a.read(), b.read(), a_pattern)
    files = context.broadcast(contents)  # two vocabularies
    kinds = _aligner(*contents).codes
    encoded = _encoded(docs, files)
    table, width, _ = pair_counts(encoded, kinds, segment_pairs)
    parts = _parts(table, width, _highest(table, kinds.n_b), table_pairs, segment_pairs)
    rows = _aligned(encoded, kinds, context.broadcast(next(parts)))  # at most table_pairs pairs, about
    for part in parts:
        rows = _filled(stage(rows, "align-links"), kinds.n_b, context.broadcast(part))
    return rows
