"""Minimal perfect hashing of distinct pairs, with dense vectors indexed by the hash.

A pair is a long. Pairs are dealt to segments by a fixed mixing of their bits. Within a
segment each level is a bitmap of twice as many places as pairs left: a pair alone at its
place there sets the bit and stays, the others go on to the next level. A pair's number is
the number of bits set before its own, so n pairs are numbered 0 to n - 1 without gaps.
The hash knows nothing of other pairs: the key at the number tells whether it is the pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from profile_lake.llm.batches import mixed

#: Bits of the mixed pair by which segments are told apart.
SPREAD_BITS = 20


def spread(pairs: np.ndarray) -> np.ndarray:
    """The top bits of the mixed pairs."""
    return (mixed(pairs.astype(np.uint64)) >> np.uint64(64 - SPREAD_BITS)).astype(np.int64)


def _places(pairs: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mixed(pairs.astype(np.uint64) ^ salt) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def build(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct pairs: the levels' sizes, their bits (64 a word) and the pairs by number."""
    sizes, bits, keys, level = [], [np.zeros(0, np.uint64)], [pairs[:0]], 0
    while len(pairs):
        size = -(-2 * len(pairs) // 64) * 64
        at = _places(pairs, level, size)
        taken = np.bincount(at, minlength=size) == 1
        stays = taken[at]
        sizes.append(size)
        bits.append(np.packbits(taken, bitorder="little").view(np.uint64))
        keys.append(pairs[stays][np.argsort(at[stays])])
        pairs, level = pairs[~stays], level + 1
    return np.array(sizes, np.int64), np.concatenate(bits), np.concatenate(keys)


@dataclass
class Segment:
    """One segment as it is stored."""

    number: int
    sizes: np.ndarray
    bits: np.ndarray
    keys: np.ndarray


class PairTable:
    """Numbers of the pairs of some segments; `width` spread values belong to one segment."""

    def __init__(self, segments: list[Segment], width: int):
        self.width = width
        self.first = min((s.number for s in segments), default=0)
        rows = max((s.number for s in segments), default=-1) - self.first + 1
        levels = max((len(s.sizes) for s in segments), default=0)
        self.size = np.zeros((rows, levels), np.int64)
        for s in segments:
            self.size[s.number - self.first, : len(s.sizes)] = s.sizes
        ordered = sorted(segments, key=lambda s: s.number)
        # Levels of a segment follow each other, so do segments.
        ends = np.cumsum(self.size.reshape(-1)).reshape(self.size.shape)
        self.base = ends - self.size
        self.bits = np.concatenate([np.zeros(0, np.uint64), *[s.bits for s in ordered]])
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits).astype(np.int64))])
        self.keys = np.concatenate([np.zeros(0, np.int64), *[s.keys for s in ordered]])

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 for pairs that are not in the table."""
        out = np.full(len(pairs), -1, np.int64)
        row = spread(pairs) // self.width - self.first
        left = np.flatnonzero((row >= 0) & (row < len(self.size)))
        for level in range(self.size.shape[1]):
            size = self.size[row[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.base[row[left], level] + _places(pairs[left], level, size)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            before = np.bitwise_count(word[here] & ((np.uint64(1) << bit[here]) - np.uint64(1)))
            out[left[here]] = self.counts[at[here] >> 6] + before
            left = left[~here]
        known = np.flatnonzero(out >= 0)
        wrong = known[self.keys[out[known]] != pairs[known]]
        out[wrong] = -1
        return out
