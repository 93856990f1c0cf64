"""op11: against a plain version that compares every pair of words."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profile_lake.llm import spelling
from profile_lake.llm.queries import QUERIES
from tests.llm import fixtures


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def cuts(word):
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling.RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_forms(words):
    sharing = {}
    for w in words:
        for cut in cuts(w):
            sharing.setdefault(cut, set()).add(w)
    near = {w: {u for cut in cuts(w) for u in sharing[cut] if is_near(w, u)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda u: (-words[u], u), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def rows_of(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_the_plain_version(spark, sf_dir, texts):
    words = brute_words(texts)
    assert len(words) > 1000
    assert rows_of(QUERIES["op11_spelling"](spark, sf_dir)) == brute_forms(words)


@pytest.mark.parametrize("alphabet, length, block_words", [("ab", 10, 8), ("abé", 8, 50), ("abcdefÿ", 7, 8192)])
def test_crowded_words_split_over_blocks(spark, alphabet, length, block_words):
    rng = random.Random(length)
    words = {}
    for _ in range(500):
        words["".join(rng.choice(alphabet) for _ in range(rng.randint(5, length)))] = int(3 * 2 ** (6 * rng.random()))
    words["a" * 700], words["a" * 699 + "b"], words["a" * 699] = 3, 6, 100
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.forms(df, block_words)) == brute_forms(words)


def test_awkward_rows(spark, awkward):
    clash = {c: F.lit("!") for c in "word n half side block holds root form".split()}
    docs = awkward.unionByName(awkward.where("doc_id = 8")).unionByName(
        awkward.where("doc_id IN (0, 23)").withColumn("doc_id", F.lit(None).cast("long"))
    ).withColumns(clash)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    words = brute_words(rows * 3)
    three = docs.unionByName(docs).unionByName(docs)
    assert {r.word: r.n for r in spelling.counted_words(three).collect()} == words
    assert rows_of(spelling.forms(spelling.counted_words(three))) == brute_forms(words)
    empty = spark.createDataFrame([], fixtures.SCHEMA)
    assert spelling.forms(spelling.counted_words(empty)).count() == 0


def test_ties_go_to_the_first_word(spark):
    df = spark.createDataFrame([("hause", 10), ("haust", 10), ("hausx", 5), ("lonely", 3)], "word string, n long")
    got = rows_of(spelling.forms(df))
    assert got["hausx"] == ("hause", "hause", 5, 2, 10)
    assert got["hause"] == (None, "hause", 10, 2, None)
    assert got["lonely"] == (None, "lonely", 3, 0, None)
