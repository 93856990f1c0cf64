"""Bidirectional FM-index over a delimited vocabulary, and searches with one error in it.

The text is every word between delimiters, `|one|two|`. A search holds an interval of
suffix ranks of the text and the interval of the same string in the reversed text; it can
be extended at either end, and many searches take each step together.

Ranks are kept as bitmaps: for each symbol c, which places of the transformed text hold a
symbol below c, with a count per 64 places. Both directions take less than half a byte a
place and symbol.
"""

from __future__ import annotations

import numpy as np

#: Symbol of the delimiter; those of the alphabet follow in code-point order.
END = 0


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start places of the rotations of ``text`` in order, by doubled prefixes."""
    n = len(text)
    rank, width = text.astype(np.int64), 1
    while True:
        pair = rank * (int(rank.max()) + 1) + rank[(np.arange(n) + width) % n]
        order = np.argsort(pair, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(pair[order]) != 0)])
        if fresh[order[-1]] == n - 1 or width >= n:
            return order
        rank, width = fresh, 2 * width


class _Ranks:
    """How many places before one hold a symbol below c."""

    def __init__(self, transformed: np.ndarray, symbols: int):
        size = len(transformed) // 64 + 1
        self.bits = np.zeros((symbols + 1, size), np.uint64)
        self.counts = np.zeros((symbols + 1, size), np.int32)
        for c in range(1, symbols + 1):
            below = np.zeros(64 * size, bool)
            below[: len(transformed)] = transformed < c
            self.bits[c] = np.packbits(below, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(self.bits[c]).astype(np.int32)
            self.counts[c, 1:] = np.cumsum(ones)[:-1]

    def below(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        block, bit = place >> 6, (place & 63).astype(np.uint64)
        inside = self.bits[symbol, block] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.counts[symbol, block] + np.bitwise_count(inside)


class BidirectionalIndex:
    """The index of distinct, non-empty words given as arrays of symbols (1 or more)."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        parts = [np.zeros(1, np.int16)]
        for word in words:
            parts += [word.astype(np.int16), parts[0]]
        text = np.concatenate(parts)[:-1]  # rotations close the circle
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        self.symbols, self.size = symbols, len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.order = suffix_order(text)
        self.word_at = np.full(len(text), -1, np.int64)
        self.word_at[starts[:-1]] = np.arange(len(words))
        backward = text[::-1]
        self.left = _Ranks(text[self.order - 1], symbols)
        self.right = _Ranks(backward[suffix_order(backward) - 1], symbols)

    def start(self, n: int) -> np.ndarray:
        """``n`` empty searches: columns rank, rank in the reversed text, size."""
        return np.tile(np.array([0, 0, self.size], np.int64), (n, 1))

    def extended(self, found: np.ndarray, symbol: np.ndarray, leftwards: bool) -> np.ndarray:
        """The searches with one symbol more at one end; a size of 0 is a miss."""
        ranks = self.left if leftwards else self.right
        one, other = (0, 1) if leftwards else (1, 0)
        low, high = found[:, one], found[:, one] + found[:, 2]
        below_low, below_high = ranks.below(symbol, low), ranks.below(symbol, high)
        before = ranks.below(symbol + 1, low) - below_low
        out = np.empty_like(found)
        out[:, one] = self.first[symbol] + before
        out[:, other] = found[:, other] + below_high - below_low
        out[:, 2] = ranks.below(symbol + 1, high) - below_high - before
        return out

    def words_of(self, found: np.ndarray) -> np.ndarray:
        """The word of each search for a whole word and both its delimiters."""
        return self.word_at[self.order[found[:, 0]]]


def one_error(index: BidirectionalIndex, queries: list[np.ndarray], leftwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the words at one inserted, deleted or replaced symbol from a query.

    One half of the query matches exactly, from its inner border outwards, delimiter
    included. Then the search turns and extends across the other half with one error: the
    right half is exact and the error in the left one if ``leftwards``, else the other way
    round. Queries have two symbols or more; words can be found more than once.
    """
    if not queries:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = np.array([len(q) for q in queries])
    half = length // 2
    # Exact part and erring part of each query in the order in which they are read.
    exact, erring = [], []
    for q, h in zip(queries, half.tolist()):
        exact.append(q[h:] if leftwards else q[:h][::-1])
        erring.append(q[:h][::-1] if leftwards else q[h:])
    exact_at, exact_of = _padded(exact), np.array([len(e) for e in exact])
    erring_at, erring_of = _padded(erring), np.array([len(e) for e in erring])

    who = np.arange(len(queries))
    found = index.start(len(queries))
    for step in range(int(exact_of.max()) + 1):
        here = step <= exact_of[who]
        symbol = np.where(step < exact_of[who], exact_at[who, np.minimum(step, exact_at.shape[1] - 1)], END)
        more = index.extended(found[here], symbol[here].astype(np.int64), not leftwards)
        found[here] = more
        alive = found[:, 2] > 0
        who, found = who[alive], found[alive]

    hits_q, hits_w = [], []
    clean, clean_who = found, who  # without an error so far, ``step`` symbols of the half read
    # With an error: searches, their query, how many symbols of the half they have read.
    late, late_who, late_read = index.start(0), who[:0], who[:0]
    symbols = np.arange(1, index.symbols, dtype=np.int64)
    step = 0
    while len(clean_who) or len(late_who):
        # Those with their error behind them go on exactly, then meet the delimiter.
        if len(late_who):
            whole = late_read == erring_of[late_who]
            symbol = np.where(whole, END, erring_at[late_who, np.minimum(late_read, erring_at.shape[1] - 1)])
            late = index.extended(late, symbol.astype(np.int64), leftwards)
            alive = late[:, 2] > 0
            done = alive & whole
            hits_q.append(late_who[done])
            hits_w.append(index.words_of(late[done]))
            late, late_who, late_read = late[alive & ~whole], late_who[alive & ~whole], late_read[alive & ~whole] + 1
        if not len(clean_who):
            continue
        left = step < erring_of[clean_who]
        own = np.where(left, erring_at[clean_who, np.minimum(step, erring_at.shape[1] - 1)], END).astype(np.int64)
        # Inserted (any symbol, nothing read) or replaced (another symbol, one read).
        n, k = len(clean_who), len(symbols)
        wide = index.extended(np.repeat(clean, k, axis=0), np.tile(symbols, n), leftwards)
        some = np.flatnonzero(wide[:, 2] > 0)
        of, symbol = some // k, symbols[some % k]
        replaced = left[of] & (symbol != own[of])
        fresh = [wide[some], wide[some[replaced]], clean[left]]
        fresh_who = [clean_who[of], clean_who[of[replaced]], clean_who[left]]
        fresh_read = [
            np.full(len(some), step), np.full(int(replaced.sum()), step + 1), np.full(int(left.sum()), step + 1),
        ]  # the last: deleted (one read, nothing matched)
        late = np.concatenate([late, *fresh])
        late_who = np.concatenate([late_who, *fresh_who])
        late_read = np.concatenate([late_read, *fresh_read])
        clean = index.extended(clean[left], own[left], leftwards)
        alive = clean[:, 2] > 0
        clean, clean_who = clean[alive], clean_who[left][alive]
        step += 1
    query, word = np.concatenate(hits_q or [who[:0]]), np.concatenate(hits_w or [who[:0]])
    return query, word


def _padded(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(parts), max(1, max(len(p) for p in parts))), np.int16)
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out
