"""Substring removal by fingerprinted 100-byte windows.

Not prefix doubling: there is no loop of ranks at growing offsets (see the README). Windows
are grouped by the anchors of :mod:`profile_lake.llm.anchors`, 56-byte grams that equal
strings share; then by the stretch from the first to beyond the last 100-byte string of an
anchor; then, only where strings of one anchor differ, every start by its first 50 bytes and
the 50 after. Each byte covered by a 100-byte string that also starts earlier is removed.

Null or empty text: no bytes. Texts shorter than the threshold stay. Every row is a document
of its own: a null doc_id is before all others, and rows of one doc_id are ordered by the
MD5 of their text, as if their ids grew that way. Empty table: empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from profile_lake.llm import anchors
from profile_lake.llm.batches import per_text, spans, text_bytes

THRESHOLD = 100
FIRST_RANK = 56


def units(threshold: int = THRESHOLD) -> anchors.Units:
    return anchors.Units(threshold, max(1, FIRST_RANK * threshold // THRESHOLD))


def _cut(threshold: int, texts: pa.Array, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, where texts begin, which bytes go, and the starts of the removed spans."""
    data, begin = text_bytes(texts)
    gone = anchors.removed_units(runs, begin, threshold)
    return data, begin, gone, spans(gone, begin)[0]


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and what is left (bytes) of every document."""

    def digest(texts: pa.Array, runs: pa.Array) -> list[pa.Array]:
        data, begin, gone, starts = _cut(threshold, texts, runs)
        left = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(begin[:-1], begin[1:])]
        return [
            pa.array(np.diff(begin)),
            pa.array(per_text(gone, begin)),
            pa.array(np.diff(np.searchsorted(starts, begin))),
            pa.array(left, pa.binary()),
        ]

    rows, ids = anchors.keyed_rows(docs)
    runs = anchors.repeated_windows(rows, units(threshold), across=False)
    return anchors.digests(rows, ids, runs, digest, "n_bytes long, n_removed long, n_spans long, kept binary")


def removal_digests(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """As :func:`remove_repeats`, with the SHA-256 of what is left instead."""

    def digest(texts: pa.Array, runs: pa.Array) -> list[pa.Array]:
        data, begin, gone, starts = _cut(threshold, texts, runs)
        left = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(begin[:-1], begin[1:])]
        return [
            pa.array(np.diff(begin)),
            pa.array(per_text(gone, begin)),
            pa.array(np.diff(np.searchsorted(starts, begin))),
            pa.array(left, pa.string()),
        ]

    rows, ids = anchors.keyed_rows(docs)
    runs = anchors.repeated_windows(rows, units(threshold), across=False)
    return anchors.digests(rows, ids, runs, digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
