"""Nulls, empty tables, repeated rows and columns with clashing names, for every operator."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profile_lake.llm import (
    bpe,
    decontaminate,
    fixity,
    jaccard,
    language,
    licences,
    pii,
    quality,
    seeds,
    suffix_dedup,
)
from profile_lake.llm.queries import rank_file
from tests.llm import brute, fixtures

ITEMS = [(1, fixtures.PASSAGE), (None, "one two"), (2, None)]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def model():
    texts = ["the cat and the dog", "der Hund und die Katze"] * 5
    return language.fit(texts, ["en", "de"] * 5)


OPERATORS = {
    "quality": lambda spark, docs: quality.judge(docs),
    "licences": lambda spark, docs: licences.scan_licences(docs),
    "language": lambda spark, docs: language.identify(docs, model()),
    "suffixes": lambda spark, docs: suffix_dedup.removal_digests(docs),
    "kept_bytes": lambda spark, docs: suffix_dedup.remove_repeats(docs),
    "pii": lambda spark, docs: pii.find(docs),
    "bpe": lambda spark, docs: bpe.round_trip(docs, *rank_file()),
    "encode": lambda spark, docs: bpe.encode(docs, *rank_file()),
    "contamination": lambda spark, docs: decontaminate.contamination(docs, items(spark)),
    "seeds": lambda spark, docs: seeds.removal_digests(docs),
    "maximal_repeats": lambda spark, docs: seeds.maximal_repeats(docs),
    "jaccard": lambda spark, docs: jaccard.component_ids(docs),
}
CLASHES = "row kept spans document key words doc low high runs n place anchor name host lang_pred score items tokens".split()


def awkward_rows(spark, awkward):
    """The fixture, twice one of its rows, null ids, and columns named like inner ones."""
    more = awkward.where("doc_id = 8").unionByName(awkward.where("doc_id IN (0, 5)").withColumn("doc_id", F.lit(None).cast("long")))
    return awkward.unionByName(more).withColumns({c: F.lit(f"{c}!") for c in CLASHES})


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, awkward, name):
    docs = awkward_rows(spark, awkward)
    got = OPERATORS[name](spark, docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    got = OPERATORS[name](spark, spark.createDataFrame([], fixtures.SCHEMA))
    assert got.count() == 0


def in_order(rows):
    """The rows numbered as the operators order them: (doc_id, null first, MD5 of the text)."""
    md5 = lambda text: hashlib.md5((text or "").encode()).hexdigest()
    return list(enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1])))))


BY_ROW = {
    "suffixes": (brute.suffixes, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "seeds": (brute.repeats, ["n_words", "n_removed", "kept_sha256"]),
    "jaccard": (brute.components, ["n_shingles", "component_id"]),
}


@pytest.mark.parametrize("name", BY_ROW)
def test_rows_of_shared_and_null_ids_count_each(spark, awkward, name):
    rows = [(r.doc_id, r.text) for r in awkward_rows(spark, awkward).collect()]
    rows += [(None, fixtures.PASSAGE + " once more"), (1, fixtures.PASSAGE), (1, "x " * 80), (2, "x " * 80), (None, None)]
    plain, columns = BY_ROW[name]
    numbered = in_order(rows)
    want = plain([(n, text) for n, (_, text) in numbered])
    if name == "jaccard":
        for row in want.values():
            row["component_id"] = numbered[row["component_id"]][1][0]
    got = OPERATORS[name](spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = Counter((doc_id, *[want[n][c] for c in columns]) for n, (doc_id, _) in numbered)
    assert Counter((r.doc_id, *[r[c] for c in columns]) for r in got) == want


def test_no_items(spark, awkward):
    for rows in ([], [(1, None), (2, "?!")]):
        got = decontaminate.contamination(awkward, items(spark, rows)).collect()
        assert len(got) == awkward.count() and not any(r.spans or r.items for r in got)


def test_items_beyond_the_broadcast_bound_hit_alike(spark, awkward, monkeypatch):
    want = {r.doc_id: (r.spans, r["items"]) for r in decontaminate.contamination(awkward, items(spark)).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    got = decontaminate.contamination(awkward, items(spark))
    assert {r.doc_id: (r.spans, r["items"]) for r in got.collect()} == want
    assert sum(bool(spans) for spans, _ in want.values()) >= 4


def test_contaminated_rows_go_and_others_stay_whole(spark, awkward):
    docs = awkward_rows(spark, awkward)
    hit = {r.doc_id for r in decontaminate.contamination(awkward, items(spark)).where("size(spans) > 0").collect()}
    left = decontaminate.without_contaminated(docs, items(spark))
    assert left.columns == docs.columns
    texts = {r.text for r in awkward.collect() if r.doc_id in hit}
    assert sorted(map(repr, left.collect())) == sorted(repr(r) for r in docs.collect() if r.text not in texts)


def test_redaction_keeps_rows_and_columns(spark):
    rows = [
        (1, "write to a.b@c.org, or +49 30 1234567!", "x"),
        (2, None, "y"),
        (3, "card 4111 1111 1111 1111 at 10.0.0.1 é a@b.c", None),
        (3, "card 4111 1111 1111 1111 at 10.0.0.1 é a@b.c", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = [tuple(r) for r in pii.redacted(docs).collect()]
    clean = (3, "card [CARD] at [IP] é [EMAIL]", None)
    assert sorted(map(repr, got)) == sorted(map(repr, [
        (1, "write to [EMAIL], or [PHONE]!", "x"), (2, None, "y"), clean, clean,
    ]))


def test_accounts_are_confirmed_by_their_remainder(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00."), (2, "IBAN DE88 3704 0044 0532 0130 00."), (3, "GB82WEST12345698765432")]
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kind = [k.name for k in pii.KINDS].index("iban")
    assert [(s.start, s.end) for s in found[1] if s.kind == kind] == [(5, 32)]
    assert [s for s in found[2] if s.kind == kind] == []
    assert [(s.start, s.end) for s in found[3] if s.kind == kind] == [(0, 22)]
    near, far = found[1][-1].score, found[3][-1].score
    assert near > far


def test_rejected_languages_go_and_null_ones_are_named(spark, awkward):
    got = language.rejects_unknown(awkward, model())
    assert got.columns == awkward.columns
    rows = {r.doc_id: r.lang for r in got.collect()}
    assert not {0, 1, 2} & rows.keys() and None not in rows.values()
    assert language.rejects_unknown(awkward, language.fit([], [])).count() == 0


def test_hosts_beyond_the_rate_take_their_documents_along(spark):
    good = "these are twelve quite different words that make one clean little document"
    rows = [(i, good if i % 10 == 0 else "bad", "farm") for i in range(300)]
    rows += [(1000 + i, good, f"h{i % 20}") for i in range(400)] + [(5000, good, None), (5001, "bad", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert not any(kept[i] for i in range(300))
    assert all(kept[1000 + i] for i in range(400))
    assert kept[5000] and not kept[5001]


def test_small_hosts_are_shrunk(spark):
    prior = quality.BetaPrior.fitted(0.1, 0.005)
    assert prior.failing / (prior.failing + prior.passing) == pytest.approx(0.1)
    assert (1 + prior.failing) / (1 + prior.failing + prior.passing) < 0.2
    assert quality.BetaPrior.fitted(None, None).failing == 0


def test_decode_gives_the_bytes_back(spark, awkward):
    encoded = bpe.encode(awkward, *rank_file())
    got = {r.doc_id: bytes(r.bytes) for r in bpe.decode(encoded, *rank_file()).collect()}
    assert got == {r.doc_id: (r.text or "").encode() for r in awkward.collect()}


def test_windows_are_shuffled_without_texts(spark, monkeypatch):
    """Beyond the broadcast bound: long texts full of hits, and no exchange of words per window."""
    words = [f"w{n}" for n in range(400)]
    rows = [(1, " ".join(words * 5)), (2, "w1 w2 " * 2000), (3, None), (3, " ".join(words[5:14])), (None, " ".join(words[5:15]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = items(spark, [(1, " ".join(words)), (2, "w1 w2 w1"), (3, "w1 w2 " * 8)])
    order = lambda df: sorted(map(repr, df.collect()))
    want = order(decontaminate.contamination(docs, wanted))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    got = decontaminate.contamination(docs, wanted)
    assert order(got) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.splitlines() if "Generate explode" in line]
    # The second of (row, words) goes no further than the explode.
    assert len(exploded) == 1 and "[1], false, [w" in exploded[0]


PAGES = "page_id long, url string, html string"


def test_audit_finds_what_differs(spark):
    rows = [(i, f"u{i}", f"page {i}") for i in range(700)]
    pages = spark.createDataFrame(rows, PAGES)
    records = fixity.manifest(pages)
    other = [(i, u, "x" if i == 300 else h) for i, u, h in rows if i != 17]
    replica = fixity.manifest(spark.createDataFrame(other, PAGES))
    assert fixity.compare(records, records).count() == 0
    assert fixity.depths(records, replica) == (0, 3)
    found = fixity.compare(records, replica).collect()
    # Later records of the replica begin elsewhere, but only the branches of 17 and 300 differ.
    assert sorted((r.level, r.page) for r in found) == [(0, 17), (0, 300), (1, 1), (1, 18), (2, 0), (2, 1), (3, 0)]
    at = {r.page_id: (r.record_offset, r.record_length) for r in records.collect()}
    moved = {r.page_id: (r.record_offset, r.record_length) for r in replica.collect()}
    assert {r.page: (r.start, r.end - r.start) for r in found if r.level == 0} == {n: at[n] for n in (17, 300)}
    lost, changed = sorted((r for r in found if r.level == 0), key=lambda r: r.page)
    assert (lost.found_start, lost.found_end, lost.found_digest) == (None, None, None)
    assert (changed.found_start, changed.found_end - changed.found_start) == moved[300]
    assert sum(n for _, n in at.values()) == max(a + n for a, n in at.values())


def test_audit_sees_moved_boundaries(spark):
    """Equal digests under other lengths make another node."""
    records = fixity.manifest(spark.createDataFrame([(i, "u", "h") for i in range(3)], PAGES))
    longer = records.withColumn("record_length", F.col("record_length") + 1)
    assert [r.level for r in fixity.compare(records, longer).collect()] == [1]


def test_audit_of_nothing_and_of_awkward_pages(spark):
    none = fixity.manifest(spark.createDataFrame([], PAGES))
    assert fixity.compare(none, none).count() == 0
    rows = [(None, None, None), (1, "u", "h"), (1, "u", "h"), (1, "u", "other"), (-5, "u", "h" * 100_000)]
    clashing = PAGES + ", place long, part string, digest string"
    records = fixity.manifest(spark.createDataFrame([(*r, 7, "p", "d") for r in rows], clashing))
    placed = {(r.record_index, r.page_id, r.place) for r in records.collect()}
    assert placed == {(0, None, 0), (1, -5, 0), (2, 1, 0), (3, 1, 1), (4, 1, 2)}
    assert fixity.compare(records, records).count() == 0
    alone = fixity.compare(records, none).collect()
    assert sorted((r.page is None, r.page or 0, r.place) for r in alone if r.level == 0) == [
        (False, -5, 0), (False, 1, 0), (False, 1, 1), (False, 1, 2), (True, 0, 0)
    ]
    assert all(r.found_digest is None and r.digest is not None for r in alone)


def test_audit_of_a_page_with_many_records(spark):
    rows = [(7, "u", f"version {n}") for n in range(300)] + [(8, "u", "h"), (None, "u", "h")]
    records = fixity.manifest(spark.createDataFrame(rows, PAGES))
    replica = fixity.manifest(spark.createDataFrame(rows[:-2] + [(8, "u", "x")], PAGES))
    assert fixity.depths(records, replica) == (3, 1)
    found = [(r.level, r.page, r.place) for r in fixity.compare(records, replica).collect()]
    assert {f for f in found if f[0] == 0} == {(0, 8, 0), (0, None, 0)}
    assert not any(page == 7 for _, page, _ in found)
