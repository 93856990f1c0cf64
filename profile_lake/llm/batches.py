"""Arrow batches of whole texts, and exact vectorised word work on their bytes.

A task never holds more than one slice of texts: a batch is cut into runs of whole
documents of about :data:`SLICE_BYTES`; one longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
BATCH_ROWS = 2000
#: Bytes after which a batch goes to Python, and the session's setting of it.
BATCH_BYTES, BATCH_BYTES_KEY = 1 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

#: Separators `[\x20\x09-\x0D]` of plain words.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
#: What is no part of an alphanumeric word: ASCII without digits and lower-case letters.
NON_ALNUM_BYTES = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of bounded text size; null texts become empty."""
    at = batch.schema.get_field_index(column)
    batch = batch.set_column(at, column, pc.coalesce(batch.column(at), pa.scalar("", pa.string())))
    ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
    first, base = 0, 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(first, last - first)
        first, base = last, int(ends[last - 1])


def map_texts(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, size: int = SLICE_BYTES
) -> DataFrame:
    """Apply ``work`` to every slice of ``df``, whose texts are in column `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=size):
                yield work(part)
        give_back()

    bound_batches(df)
    return df.mapInArrow(run, schema)


def bound_batches(df: DataFrame) -> None:
    """Have the session send at most :data:`BATCH_ROWS` rows and about :data:`BATCH_BYTES` at once to Python.

    Rows are whole texts: the usual ten thousand, or 64 MB, would be held several times over,
    in the executor's native memory and in Python.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system at a task's end.

    Python workers outlive their tasks, and what they keep adds to the executor's share
    while later stages run.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins (with the end as last entry)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    begin = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), begin - begin[0]
    return np.frombuffer(data, np.uint8)[begin[0] : begin[-1]], begin - begin[0]


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def spans(inside: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a text's border: their starts and ends."""
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = begin[(begin > 0) & (begin < len(inside))]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def per_text(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each text's range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, dtype=np.int64, out=total[1:])
    return total[begin[1:]] - total[begin[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Fingerprints are polynomials modulo this prime: modulo 2**64 strings of Thue-Morse kind collide for every base.
PRIME = np.uint64((1 << 61) - 1)
#: Bases of the two lanes of fingerprints; a name of both has 122 bits.
BASES = (0x1E3779B97F4A7C15, 0x11342543DE82EF95)
#: Sums of longer stretches could pass 64 bits.
LONG_STRETCH = 1 << 23
_powers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def reduced(x: np.ndarray) -> np.ndarray:
    """Modulo :data:`PRIME`."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo :data:`PRIME`, of reduced numbers: by halves of 30 and 31 bits."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0 + a0 * b1
    ends = reduced(np.uint64(2) * (a1 * b1)) + reduced(a0 * b0)
    return reduced(ends + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of base**i modulo :data:`PRIME` the low 32 bits and the rest, and base**-i, for i < n."""
    if base not in _powers or len(_powers[base][0]) < n:
        size, made, prime = max(n, 1 << 16), [], int(PRIME)
        for b in (base, pow(base, -1, prime)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, product(p, np.uint64(pow(b, len(p), prime)))])
            made.append(p[:size].copy())
        low, rest = (made[0] & np.uint64(0xFFFFFFFF)), made[0] >> np.uint64(32)
        _powers[base] = (low.astype(np.uint32), rest.astype(np.uint32), made[1])
    low, rest, down = _powers[base]
    return low[:n], rest[:n], down[:n]


class Rolling:
    """64-bit fingerprints of any stretches of a sequence of bytes or of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        self._values = values
        low, rest, self._down = powers(base, len(values) + 1)
        if values.dtype == np.uint8:
            terms = values, values
        else:
            whole = product(reduced(values), low[:-1].astype(np.uint64) + (rest[:-1].astype(np.uint64) << np.uint64(32)))
            terms = whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32)
        # Sums wrap around, their differences are right while a stretch's own sum fits.
        self._low, self._rest = (self._summed(x, p[:-1]) for x, p in zip(terms, (low, rest)))

    @staticmethod
    def _summed(terms: np.ndarray, powers: np.ndarray) -> np.ndarray:
        total = np.zeros(len(terms) + 1, np.uint64)
        sums = total[1:]
        if terms.dtype == np.uint8:
            # No byte counts as zero: a stretch and the same after zeros would be one.
            np.multiply(terms, powers, out=sums, dtype=np.uint64)
            sums += powers
            terms = sums
        np.cumsum(terms, out=sums)
        return total

    @staticmethod
    def _name(low: np.ndarray, rest: np.ndarray, down: np.ndarray) -> np.ndarray:
        high = product(reduced(rest), np.uint64(1 << 32))
        return mixed(product(reduced(reduced(low) + high), down))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        names = self._name(
            self._low[ends] - self._low[starts], self._rest[ends] - self._rest[starts], self._down[starts]
        )
        for i in np.flatnonzero(ends - starts > LONG_STRETCH):
            salt = int(self._down[1]).to_bytes(8, "little")
            digest = hashlib.blake2b(self._values[starts[i] : ends[i]].tobytes(), digest_size=8, key=salt).digest()
            names[i] = int.from_bytes(digest, "little")
        return names

    def windows(self, size: int) -> np.ndarray:
        """Of every window of ``size`` values, by its start."""
        n = max(0, len(self._low) - size)
        return self._name(self._low[size:] - self._low[:n], self._rest[size:] - self._rest[:n], self._down[:n])


class Words:
    """Words of a slice of texts: their spans in the bytes and 64-bit fingerprints."""

    def __init__(self, texts: pa.Array, separators: bytes, lower: bool = False):
        self.data, self.begin = text_bytes(texts)
        if lower:
            self.data = lower_ascii(self.data)
        self.inside = ~byte_table(separators)[self.data]
        self.starts, self.ends = spans(self.inside, self.begin)
        #: Of each text, its first word; the last entry is the number of words.
        self.first = np.searchsorted(self.starts, self.begin)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, base: int = BASES[0]) -> np.ndarray:
        return Rolling(self.data, base).of(self.starts, self.ends)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` items that lie within one text."""
    end_of = np.repeat(first[1:], np.diff(first))
    return np.flatnonzero(np.arange(len(end_of)) + size <= end_of)


def covered(starts: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a stretch that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0
