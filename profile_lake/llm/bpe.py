"""Byte-level BPE encoding and decoding by recursive SQL inside each partition.

A text is cut into words by the tokenizer's pattern. Distinct words of a partition
become token-position rows in DuckDB; a recursive query joins neighbouring tokens to the
merge table, contracts each word's leftmost pair of least rank, and goes on until no word
has a pair left. Decoding joins token ids to their bytes and concatenates them in order.

Words seen before are remembered in the Python worker, up to :data:`REMEMBERED`. A word
longer than :data:`LONG_WORD` bytes is contracted by the same rule with a priority queue: the
recursive query keeps every round, which for n bytes are n * n / 2 rows.

Null or empty text: no tokens, empty bytes. Repeated rows: each gets its result. Empty
table: empty result. Other columns are not read. The rank file is read on the driver from
the given path and sent along: its size is fixed by the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profile_lake.llm.batches import map_texts

#: Bounds what a worker holds: texts' chunks remembered, and words contracted by one query.
REMEMBERED = 450_000
WORDS_PER_QUERY = 20_000
LONG_WORD = 64
#: Texts handled at once: the more, the fewer times a word is looked up.
TEXT_BYTES = 6 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by rank, and the pattern that cuts a text into words."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def merges(self) -> list[tuple[int, int, int]]:
        """Every pair of tokens whose bytes together are a token: left, right, merged."""
        out = []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    out.append((left, right, rank))
        return out


# One round: a word's token positions join the merge table as neighbours; the pair of least
# rank, the leftmost of those, is contracted. Words without a pair are settled and leave.
_ENCODE = """
    WITH RECURSIVE rounds(word, tokens, open) AS (
        SELECT word, tokens, true FROM start
        UNION ALL
        SELECT
            r.word,
            CASE WHEN p.least IS NULL THEN r.tokens
                 ELSE list_concat(
                     list_append(r.tokens[1:(p.least % 4294967296) - 1], (p.least // 4294967296)::INTEGER),
                     r.tokens[(p.least % 4294967296) + 2:]
                 ) END,
            p.least IS NOT NULL
        FROM rounds r
        LEFT JOIN (
            SELECT word, min(m.merged::BIGINT * 4294967296 + pos) AS least
            FROM (
                SELECT word, unnest(tokens[:-2]) AS lefthand, unnest(tokens[2:]) AS righthand,
                       generate_subscripts(tokens[2:], 1) AS pos
                FROM rounds WHERE open
            )
            JOIN merges m USING (lefthand, righthand)
            GROUP BY word
        ) p ON p.word = r.word
        WHERE r.open
    )
    SELECT tokens FROM rounds WHERE NOT open ORDER BY word
"""

_DECODE = """
    SELECT e.word, unhex(coalesce(t.hex, '')) AS raw
    FROM encoded e LEFT JOIN (
        SELECT w.word, string_agg(v.hex, '' ORDER BY w.pos) AS hex
        FROM (SELECT word, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM encoded) w
        JOIN vocabulary v ON v.token = w.token
        GROUP BY w.word
    ) t ON t.word = e.word
    ORDER BY e.word
"""


class WordCodec:
    """Encodes and decodes words with DuckDB; one per Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self._ranks = vocabulary.ranks
        self._split = regex.compile(vocabulary.pattern)
        self._other_space = re.compile(r"[^\S \n]")
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB"})
        merges = vocabulary.merges()
        self._merged = {(left, right): merged for left, right, merged in merges}
        for name, columns in (
            ("merges", {"lefthand": [m[0] for m in merges], "righthand": [m[1] for m in merges], "merged": [m[2] for m in merges]}),
            ("vocabulary", {"token": list(self._ranks.values()), "hex": [t.hex() for t in self._ranks]}),
        ):
            self._db.register("incoming", pa.table(columns))
            self._db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self._db.unregister("incoming")
        self._byte_ids = np.array([self._ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        #: Ids in decimal of remembered chunks: the newer half, the older. Where decoding them
        #: gave other bytes than the chunk's (a vocabulary without some byte), these too.
        self._newer: dict[str, str | tuple[str, bytes]] = {}
        self._older: dict[str, str | tuple[str, bytes]] = {}
        self._lossy = False

    def _asked(self, query: str, **inputs: pa.Table) -> pa.Table:
        for name, table in inputs.items():
            self._db.register(name, table)
        out = self._db.sql(query).to_arrow_table()
        for name in inputs:
            self._db.unregister(name)
        return out

    def _contracted(self, words: list[bytes]) -> pa.ListArray:
        """Token ids of some words, by the recursive query."""
        ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
        tokens = self._byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        start = pa.table(
            {"word": np.arange(len(words)), "tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens))}
        )
        return self._asked(_ENCODE, start=start)["tokens"].combine_chunks()

    def _by_queue(self, raw: bytes) -> list[int]:
        """A long word by the same rule, the least (rank, place) taken from a priority queue."""
        token = [int(self._byte_ids[b]) for b in raw]
        after, before = list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))
        queue = [(self._merged[p], i, *p) for i, p in enumerate(zip(token, token[1:])) if p in self._merged]
        heapify(queue)
        while queue:
            merged, i, left, right = heappop(queue)
            j = after[i]
            if token[i] != left or j >= len(raw) or token[j] != right:
                continue  # one of the two was contracted meanwhile
            token[i], token[j] = merged, -1
            after[i] = after[j]
            if after[i] < len(raw):
                before[after[i]] = i
            for k, m in ((before[i], i), (i, after[i])):
                pair = (token[k], token[m]) if k >= 0 and m < len(raw) else None
                if pair in self._merged:
                    heappush(queue, (self._merged[pair], k, *pair))
        return [t for t in token if t >= 0]

    def encode_words(self, words: list[bytes]) -> pa.ListArray:
        """Token ids of each word; a word that is a token is that token."""
        whole, long, short = [], [], []
        for i, raw in enumerate(words):
            if not raw or raw in self._ranks:
                whole.append(i)
            else:
                (long if len(raw) > LONG_WORD else short).append(i)
        kind = pa.list_(pa.int32())
        parts = [
            pa.array([[self._ranks[words[i]]] if words[i] else [] for i in whole], kind),
            pa.array([self._by_queue(words[i]) for i in long], kind),
        ]
        for first in range(0, len(short), WORDS_PER_QUERY):
            parts.append(self._contracted([words[i] for i in short[first : first + WORDS_PER_QUERY]]).cast(kind))
        place = np.empty(len(words), np.int64)
        place[np.array([*whole, *long, *short], np.int64)] = np.arange(len(words))
        return pa.concat_arrays(parts).take(pa.array(place))

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        """Bytes of each id sequence."""
        out: list[bytes] = []
        for first in range(0, len(ids), WORDS_PER_QUERY):
            part = ids.slice(first, WORDS_PER_QUERY)
            encoded = pa.table({"word": np.arange(len(part)), "tokens": part})
            out += self._asked(_DECODE, encoded=encoded)["raw"].to_pylist()
        return out

    def lone_spaces(self, text: str) -> bool:
        """Whether every space has a neighbour on both sides that is no white space."""
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return False
        return not (" \n" in text or "\n " in text or self._other_space.search(text))

    def chunks(self, text: str) -> list[str]:
        """The text in stretches that the pattern never joins: it cuts before a lone space.

        A lone space belongs to the next word, as neither neighbour is white space.
        """
        out: list[list[str]] = [[]]
        before = " "
        for i, part in enumerate(text.split(" ")):
            if i and part and not part[0].isspace() and not before.isspace():
                out.append([])
            out[-1].append(" " + part if i else part)
            before = part[-1] if part else " "
        return ["".join(c) for c in out if c != [""]]

    def _remembered(self, chunks: set[str]) -> dict[str, str | tuple[str, bytes]]:
        """All of ``chunks``, encoding and decoding those that are new."""
        if len(self._newer) + len(chunks) > REMEMBERED // 2:
            self._newer, self._older = {}, self._newer
        known = self._newer
        fresh = []
        for chunk in chunks - known.keys():
            old = self._older.get(chunk)
            if old is None:
                fresh.append(chunk)
            else:
                known[chunk] = old
        # A space and letters are one word; what else there is, the pattern tells.
        pieces = [[c] if c[1:].isalpha() and (c[0] == " " or c[0].isalpha()) else self._split.findall(c) for c in fresh]
        number: dict[str, int] = {}
        for piece in pieces:
            for word in piece:
                number.setdefault(word, len(number))
        raw = [w.encode() for w in number]
        encoded = self.encode_words(raw)
        decoded = self.decode(encoded)
        decimal = pa.ListArray.from_arrays(encoded.offsets, encoded.values.cast(pa.string()))
        ids = pc.binary_join(decimal, " ").to_pylist()
        same = decoded == raw
        self._lossy = self._lossy or not same
        for chunk, piece in zip(fresh, pieces):
            at = [number[w] for w in piece]
            known[chunk] = ids[at[0]] if len(at) == 1 else " ".join([ids[i] for i in at])
            if not same and any(decoded[i] != raw[i] for i in at):
                known[chunk] = known[chunk], b"".join([decoded[i] for i in at])
        return known

    def _both(self, chunks: list[str], known: dict[str, str | tuple[str, bytes]]) -> tuple[list[str], list[bytes]]:
        """Ids in decimal and decoded bytes of remembered chunks."""
        found = [known[c] for c in chunks]
        if not self._lossy:
            return found, [c.encode() for c in chunks]
        whole = [f if isinstance(f, tuple) else (f, c.encode()) for f, c in zip(found, chunks)]
        return [w[0] for w in whole], [w[1] for w in whole]

    def texts(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Ids in decimal, joined by spaces, and the bytes they decode to, of each text."""
        plain = [bool(t) and self.lone_spaces(t) for t in texts]
        cut = [[] if p else self.chunks(t) for p, t in zip(plain, texts)]
        split = pc.split_pattern(pa.array([t if p else "" for p, t in zip(plain, texts)], pa.string()), " ")
        words = split.flatten().dictionary_encode()
        # In a list of words the first has no space before it: it is looked up apart.
        firsts = [t.split(" ", 1)[0] if p else "" for p, t in zip(plain, texts)]
        spaced = pc.binary_join_element_wise("", words.dictionary, " ")
        distinct = pc.if_else(pc.equal(words.dictionary, ""), "", spaced).to_pylist()
        known = self._remembered(set(distinct).union(firsts, *cut) - {""})
        known.setdefault("", "")
        heads = [self._both([f] if p else chunks, known) for p, f, chunks in zip(plain, firsts, cut)]
        rest = pc.list_slice(split, 1)
        inner = np.ones(len(words), bool)
        inner[np.asarray(split.offsets)[:-1]] = False
        index = words.indices.filter(pa.array(inner))
        out = []
        found = self._both(distinct, known)
        for part, kind, gap in ((0, pa.string(), " "), (1, pa.binary(), b"")):
            values = pa.array(found[part], kind).take(index)
            tails = pc.binary_join(pa.ListArray.from_arrays(rest.offsets, values), gap)
            begun = pa.array([gap.join(head[part]) for head in heads], kind)
            used = pc.equal(pc.list_value_length(rest), 0)
            out.append(pc.if_else(used, begun, pc.binary_join_element_wise(begun, tails, gap)))
        return out[0], out[1]


_codecs: dict[str, WordCodec] = {}


def codec_for(key: str, vocabulary: Vocabulary) -> WordCodec:
    """The worker's codec for a vocabulary; kept between tasks."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = WordCodec(vocabulary)
    return _codecs[key]


def _sent(docs: DataFrame, path: str, pattern: str):
    vocabulary = Vocabulary.read(path, pattern)
    key = hashlib.sha256(repr((sorted(vocabulary.ranks.items()), pattern)).encode()).hexdigest()
    return key, docs.sparkSession.sparkContext.broadcast(vocabulary)  # fixed by the vocabulary file


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the token ids of every document."""
    key, sent = _sent(docs, path, pattern)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        decimal, _ = codec_for(key, sent.value).texts(part.column(1).to_pylist())
        ids = pa.array([[int(x) for x in d.split()] for d in decimal.to_pylist()], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    schema = "doc_id long, ids array<int>"
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), work, schema, TEXT_BYTES)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of every row of ids; null ids are none."""
    key, sent = _sent(encoded, path, pattern)

    def work(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                ids = pa.array([x or [] for x in part.column(1).to_pylist()], pa.list_(pa.int32()))
                made = codec_for(key, sent.value).decode(ids)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], ["doc_id", "bytes"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(work, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of the ids and of the bytes they decode to, for every document."""
    key, sent = _sent(docs, path, pattern)
    digest = lambda raw: hashlib.sha256(raw).hexdigest()

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, decoded = codec_for(key, sent.value).texts(part.column(1).to_pylist())
        ids = [i.encode() for i in ids.to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([i.count(b" ") + 1 if i else 0 for i in ids], pa.int64()),
                pa.array([digest(i) for i in ids], pa.string()),
                pa.array([digest(d) for d in decoded.to_pylist()], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_texts(
        docs.select(F.col("doc_id").cast("long"), "text"),
        work,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        TEXT_BYTES,
    )
