"""Every query over a whole table against the plain versions in brute.py."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from profile_lake.llm.queries import QUERIES
from tests.llm import brute


def by_id(spark, sf_dir, name):
    rows = [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    return out


def compare(got, want):
    assert got.keys() == want.keys()
    for doc_id, row in want.items():
        mine = {k: got[doc_id][k] for k in row}
        assert mine == row, doc_id


def test_quality(spark, sf_dir, texts):
    got = by_id(spark, sf_dir, "op1_quality")
    compare(got, {d: brute.quality(t) for d, t in texts})
    assert all(not (r["kept"] and r["base_failed"]) for r in got.values())


def test_licences(spark, sf_dir, texts):
    got = by_id(spark, sf_dir, "op2_licences")
    compare(got, {d: brute.licences(t) for d, t in texts})
    for r in got.values():
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_pii(spark, sf_dir, texts):
    compare(by_id(spark, sf_dir, "op5_pii"), {d: brute.personal(t) for d, t in texts})


def test_bpe(spark, sf_dir, texts):
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc_id, text in texts:
        ids = library.encode_ordinary(text or "")
        want[doc_id] = {
            "n_tokens": len(ids),
            "ids_sha256": brute.sha(" ".join(map(str, ids))),
            "decoded_sha256": hashlib.sha256((text or "").encode()).hexdigest(),
        }
    compare(by_id(spark, sf_dir, "op6_bpe"), want)


def test_decontamination(spark, sf_dir, texts, items):
    want = {r["doc_id"]: r for r in brute.contamination(texts, items)}
    assert any(r["contaminated"] for r in want.values())
    compare(by_id(spark, sf_dir, "op8_decontaminate"), want)


@pytest.mark.skipif("op4_suffixes" not in QUERIES, reason="not registered")
def test_suffixes(spark, sf_dir, texts):
    compare(by_id(spark, sf_dir, "op4_suffixes"), brute.suffixes(texts))


@pytest.mark.skipif("op9_repeats" not in QUERIES, reason="not registered")
def test_repeats(spark, sf_dir, texts):
    compare(by_id(spark, sf_dir, "op9_repeats"), brute.repeats(texts))


@pytest.mark.skipif("op10_jaccard" not in QUERIES, reason="not registered")
def test_jaccard(spark, sf_dir, texts):
    compare(by_id(spark, sf_dir, "op10_jaccard"), brute.components(texts))


def test_language(spark, sf_dir):
    got = by_id(spark, sf_dir, "op3_language")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert got.keys() == {d.doc_id for d in docs}
    held = [d for d in docs if got[d.doc_id]["held_out"] and d.lang and d.doc_id < 200]
    right = sum(got[d.doc_id]["lang_pred"] == d.lang for d in held)
    assert len(held) > 20 and right >= 0.97 * len(held)
    for d in docs:
        letters = any(c.isalpha() for c in d.text or "")
        assert (got[d.doc_id]["lang_pred"] == "und") == (not letters)
        assert 0 <= got[d.doc_id]["score"] <= 1
