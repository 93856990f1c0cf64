"""The pipeline against a plain chain of its stages."""

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import tiktoken

import corpus_pipeline
from profile_lake.llm import language
from profile_lake.llm.queries import documents, held_out
from tests.llm import brute


def plain_pipeline(spark, sf_dir, texts, items):
    model = language.trained(documents(spark, sf_dir), ~held_out())
    known = []
    for doc_id, text in texts:
        (label,), (score,) = model.predict(pa.array([text or ""]))
        if label != "und" and score >= 0.25:
            known.append((doc_id, text))
    groups = brute.components(known, size=5, percent=80)
    firsts = [(d, t) for d, t in known if groups[d]["component_id"] == d]
    clean = {r["doc_id"] for r in brute.contamination(firsts, items) if not r["contaminated"]}
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {}
    for doc_id, text in firsts:
        if doc_id in clean:
            text = brute.redacted(text)
            ids = library.encode_ordinary(text)
            out[doc_id] = (len(ids), brute.sha(" ".join(map(str, ids))), hashlib.sha256(text.encode()).hexdigest())
    return out


def test_pipeline(spark, sf_dir, texts, items):
    want = plain_pipeline(spark, sf_dir, texts, items)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows}
    assert len(got) == len(rows) and got == want
    assert 100 < len(got) < len(texts) - 10


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "jaccard_join", "decontamination", "pii", "bpe"]
