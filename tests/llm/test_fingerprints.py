"""Fingerprints of stretches, and texts built so that polynomials modulo 2**64 collide."""

import numpy as np
import pytest

from profile_lake.llm import batches, jaccard, quality, seeds, suffix_dedup
from profile_lake.llm.batches import BASES, PRIME, Rolling
from tests.llm import brute

THUE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
MORSE = "".join("ba"[bin(i).count("1") % 2] for i in range(1024))
WORDS = [f"w{i}" for i in range(60)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id long, text string, source string")


def test_products_equal_whole_numbers():
    prime = int(PRIME)
    rng = np.random.default_rng(0)
    edge = [0, 1, 2, prime - 1, prime - 2, (1 << 31) - 1, 1 << 31, (1 << 60) + 1]
    a = np.array([*edge, *edge[::-1], *rng.integers(0, prime, 500)], np.uint64)
    b = np.array([*edge, *edge, *rng.integers(0, prime, 500)], np.uint64)
    assert batches.product(a, b).tolist() == [int(x) * int(y) % prime for x, y in zip(a, b)]
    assert batches.product(a, np.uint64(1 << 32)).tolist() == [(int(x) << 32) % prime for x in a]
    low, rest, down = batches.powers(BASES[0], 70000)
    for i in (0, 1, 63, 64, 65536, 69999):
        assert int(low[i]) + (int(rest[i]) << 32) == pow(BASES[0], i, prime)
        assert int(down[i]) == pow(BASES[0], -i, prime)


@pytest.mark.parametrize("base", BASES)
def test_names_follow_the_polynomial_wherever_a_stretch_lies(base):
    prime, rng = int(PRIME), np.random.default_rng(1)
    for values in (rng.integers(0, 256, 400).astype(np.uint8), rng.integers(0, 1 << 64, 400, dtype=np.uint64)):
        values[200:300] = values[50:150]
        plain = [int(v) + 1 if values.dtype == np.uint8 else int(v) % prime for v in values]
        starts, ends = np.array([0, 50, 200, 399, 7]), np.array([400, 150, 300, 400, 7])
        got = Rolling(values, base).of(starts, ends)
        want = [sum(v * pow(base, i, prime) for i, v in enumerate(plain[a:b])) % prime for a, b in zip(starts, ends)]
        assert got.tolist() == batches.mixed(np.array(want, np.uint64)).tolist()
        assert Rolling(values, base).windows(100)[[50, 200]].tolist() == got[[1, 2]].tolist()


def test_long_stretches_have_names_of_their_own(monkeypatch):
    monkeypatch.setattr(batches, "LONG_STRETCH", 8)
    values = np.frombuffer(b"abcdefghijk-abcdefghijk-abcdefghijX", np.uint8)
    names = Rolling(values).of(np.array([0, 12, 24]), np.array([11, 23, 35]))
    assert names[0] == names[1] != names[2]


def test_unlike_lines_are_no_duplicates(spark):
    texts = [f"{THUE}\n{MORSE}", f"{THUE}\n{THUE}", f"{THUE} a b c d {MORSE} a b c d"]
    got = quality.judge(docs_of(spark, enumerate(texts))).collect()
    for r in got:
        want = brute.quality(texts[r.doc_id])
        assert {k: r[k] for k in want} == want
    assert sorted(r.n_dup_lines for r in got) == [0, 0, 1]


def test_documents_unlike_in_one_word_stay_whole(spark):
    rows = [(i, " ".join([*WORDS[:30], word, *WORDS[30:]])) for i, word in enumerate([THUE, MORSE])]
    assert {r.n_removed for r in seeds.removal_digests(docs_of(spark, rows)).collect()} == {0}
    same = [*rows, (2, rows[0][1])]
    assert {r.doc_id: r.n_removed for r in seeds.removal_digests(docs_of(spark, same)).collect()} == {0: 0, 1: 0, 2: 61}


def test_unlike_documents_are_not_joined(spark):
    rows = [(i, " ".join([*WORDS[:3], word, *WORDS[3:6]])) for i, word in enumerate([THUE, MORSE])]
    got = {r.doc_id: r.component_id for r in jaccard.component_ids(docs_of(spark, rows)).collect()}
    assert got == {d: r["component_id"] for d, r in brute.components(rows).items()} == {0: 0, 1: 1}


def test_bytes_of_unlike_texts_stay(spark):
    rows = [(0, THUE), (1, MORSE), (2, MORSE[:512] + "!" + MORSE[512:])]
    got = {r.doc_id: r.asDict() for r in suffix_dedup.removal_digests(docs_of(spark, rows)).collect()}
    want = brute.suffixes(rows)
    assert {d: {k: got[d][k] for k in row} for d, row in want.items()} == want
