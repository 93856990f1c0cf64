"""op12: against whole-text encodings by both libraries, and the pair table by itself."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from profile_lake.llm import alignment
from profile_lake.llm.pair_table import PairTable, Segment, SPREAD_BITS, build, spread
from profile_lake.llm.queries import QUERIES, tokenizer_files
from tests.llm import fixtures

STRANGE = [
    "a\tb\nc\r\n", "\x00x y", "a▁b", "é è  ñ ", " lead", "tail ", " ", "  ", "ﬁ①Å​ z", "<s> </s> <unk> <|endoftext|> <0x0A>",
    "日本語 のテキスト、 です。", "🙂 🙃🙂", "don't we'll  he'd   'S", "x" * 5000, "word " * 3000, "\u0085     x", "a \n \n b",
]


def brute(texts):
    a_path, b_path, _ = tokenizer_files()
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    symbol = alignment._bytes_of_symbols()
    names = {n: t for t, n in a.get_vocab().items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        one = [(i, bytes(symbol[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, b_bytes(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        return (one, two) if b"".join(x for _, x in one) == whole == b"".join(x for _, x in two) else ([], [])

    out, links = [], []
    for text in texts:
        one, two = tokens(text)
        ends_a = dict(zip(np.cumsum([len(x) for _, x in one]).tolist(), range(len(one))))
        ends_b = dict(zip(np.cumsum([len(x) for _, x in two]).tolist(), range(len(two))))
        both = sorted(ends_a.keys() & ends_b.keys())
        groups, i, j, own = [], 0, 0, []
        for e in both:
            x, y = ends_a[e] + 1, ends_b[e] + 1
            groups.append(",".join(str(t) for t, _ in one[i:x]) + "|" + ",".join(str(t) for t, _ in two[j:y]))
            own.append((one[x - 1][0], two[y - 1][0]))
            i, j = x, y
        links.append(own)
        out.append((len(one), len(two), len(groups), len(own), ";".join(groups)))
    count = Counter(p for own in links for p in own)
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return [
        (*row[:4], sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own),
         hashlib.sha256(row[4].encode()).hexdigest() if row[4] else "")
        for row, own in zip(out, links)
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_whole_text_encodings(spark, tmp_path):
    docs = spark.read.parquet(f"{fixtures.SF}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*STRANGE, *fixtures.TEXTS])], docs.schema)
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    want = dict(zip([d for d, _ in rows], brute([t for _, t in rows])))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_alignment"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for doc_id in want:
        assert got[doc_id] == want[doc_id], doc_id
    assert want[10_002] == (0, 0, 0, 0, 0, 0, "")


@pytest.mark.parametrize("table_pairs, quick", [(64, True), (1 << 21, False)])
def test_parts_of_the_table_give_the_same(spark, table_pairs, quick):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(STRANGE * 2)], "doc_id long, text string")
    a, b, pattern = tokenizer_files()
    found = alignment.align(docs, a, b, pattern if quick else None, table_pairs=table_pairs, segment_pairs=16)
    got = found.orderBy("doc_id").collect()
    want = brute(STRANGE * 2)
    assert [(r.n_a, r.n_b, r.n_groups, len(r.links)) for r in got] == [w[:4] for w in want]
    assert [(sum(x.best for x in r.links), sum(x.n for x in r.links)) for r in got] == [w[4:6] for w in want]


def test_texts_are_encoded_once(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(STRANGE)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    found = alignment.align(spark.read.parquet(f"{tmp_path}/docs"), *tokenizer_files())
    assert found.inputFiles() and all("/align-codes-" in f for f in found.inputFiles())
    assert [r.n_a for r in found.orderBy("doc_id").collect()] == [w[0] for w in brute(STRANGE)]


def test_codes_tell_groups_and_links():
    kinds = alignment.Codes(10, 20)
    # 1,2|3;4|5,6 then a text without tokens, then 7|8.
    codes = np.array([2, 5, 20 + 10, 9, 20 + 15, 20 + 20, 15, 20 + 26], np.int32)
    begin = np.array([0, 6, 6, 8])
    at, pairs = kinds.pairs(codes)
    assert at.tolist() == [2, 5, 7]
    assert pairs.tolist() == [2 * 20 + 3, 4 * 20 + 6, 7 * 20 + 8]
    assert kinds.groups(codes, begin).to_pylist() == ["1,2|3;4|5,6", "", "7|8"]


def test_awkward_rows(spark, awkward):
    clash = "row pair n segment branch keys counts links groups".split()
    docs = awkward.unionByName(awkward.where("doc_id = 5")).unionByName(
        awkward.where("doc_id IN (0, 5)").withColumn("doc_id", F.lit(None).cast("long"))
    ).withColumns({c: F.lit("!") for c in clash})
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_a, r.groups) for r in alignment.align(docs, *tokenizer_files()).collect()))
    plain = {r.doc_id: (r.n_a, r.groups) for r in alignment.align(awkward, *tokenizer_files()).collect()}
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert [(x[0], x[1]) for x in got] == sorted((d is None, d or 0) for d in ids)
    for null, doc_id, n_a, groups in got:
        assert (n_a, groups) in (([plain[0], plain[5]]) if null else [plain[doc_id]])
    assert alignment.align(docs.limit(0), *tokenizer_files()).count() == 0


def test_numbers_are_minimal_and_verified():
    rng = np.random.default_rng(3)
    pairs = np.unique(rng.integers(0, 1 << 40, 20_000))
    width = (1 << SPREAD_BITS) // 8
    of = spread(pairs) // width
    table = PairTable([Segment(s, *build(pairs[of == s])) for s in range(8)], width)
    got = table.numbers(pairs)
    assert sorted(got) == list(range(len(pairs)))
    assert (table.keys[got] == pairs).all()
    assert (table.numbers(np.setdiff1d(rng.integers(0, 1 << 40, 20_000), pairs)) == -1).all()
    some = PairTable([Segment(s, *build(pairs[of == s])) for s in (2, 3)], width)
    assert ((some.numbers(pairs) >= 0) == ((of == 2) | (of == 3))).all()
    assert len(PairTable([], width).numbers(pairs)) == len(pairs)
