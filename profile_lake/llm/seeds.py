"""Substring removal across documents by fingerprinted 50-word windows.

Not seed and extend: no places are paired and no match is extended (see the README).
Windows are grouped by winnowed seeds, of every 50 words in a row the leftmost 16-word gram
of least fingerprint. Where the stretches of one seed are equal whole, they are repeats
whole, and where they differ, each of their windows is compared. Runs of repeated windows
are the maximal repeats over the threshold. :mod:`profile_lake.llm.anchors` has the rounds.

Each word covered by a window that also starts in a document of smaller doc_id is
removed. Null or empty text: no words. Every row is a document of its own: a null doc_id is
before all others, and rows of one doc_id are ordered by the MD5 of their text, as if their
ids grew that way. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from profile_lake.llm import anchors
from profile_lake.llm.batches import SPACE_BYTES, Words, per_text, spans

THRESHOLD = 50
SEED = 16


def units(threshold: int = THRESHOLD) -> anchors.Units:
    return anchors.Units(threshold, max(1, min(SEED, threshold // 2)), SPACE_BYTES)


def maximal_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words and the maximal repeats {start, end} in words of every document."""

    def digest(texts: pa.Array, runs: pa.Array) -> list[pa.Array]:
        words = Words(texts, SPACE_BYTES)
        gone = anchors.removed_units(runs, words.first, threshold)
        low, high = spans(gone, words.first)
        text = np.searchsorted(words.first, low, "right") - 1
        base = words.first[text]
        found = pa.StructArray.from_arrays([pa.array(low - base), pa.array(high - base)], ["start", "end"])
        at = pa.array(np.searchsorted(low, words.first).astype(np.int32))
        return [pa.array(words.counts), pa.ListArray.from_arrays(at, found)]

    rows, ids = anchors.keyed_rows(docs)
    runs = anchors.repeated_windows(rows, units(threshold), across=True)
    return anchors.digests(rows, ids, runs, digest, "n_words long, repeats array<struct<start:bigint,end:bigint>>")


def removal_digests(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the words left of every document."""

    def digest(texts: pa.Array, runs: pa.Array) -> list[pa.Array]:
        words = Words(texts, SPACE_BYTES)
        gone = anchors.removed_units(runs, words.first, threshold)
        raw, left = words.data.tobytes(), []
        for first, last in zip(words.first[:-1], words.first[1:]):
            kept = np.flatnonzero(~gone[first:last]) + first
            pairs = zip(words.starts[kept].tolist(), words.ends[kept].tolist())
            left.append(hashlib.sha256(b" ".join([raw[a:b] for a, b in pairs])).hexdigest())
        return [pa.array(words.counts), pa.array(per_text(gone, words.first)), pa.array(left, pa.string())]

    rows, ids = anchors.keyed_rows(docs)
    runs = anchors.repeated_windows(rows, units(threshold), across=True)
    return anchors.digests(rows, ids, runs, digest, "n_words long, n_removed long, kept_sha256 string")
