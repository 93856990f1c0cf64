"""op13: against a plain partition, and the law it promises."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from profile_lake.llm import sharding
from profile_lake.llm.queries import QUERIES
from tests.llm import fixtures


def plain_cuts(sizes, shards):
    """Starts of the shards 1, 2, … over group sizes, by the same rule with every border known."""
    borders = [0]
    for size in sizes:
        borders.append(borders[-1] + size)
    total = borders[-1]

    def fits(capacity):
        here = 0
        for _ in range(shards):
            here = max(b for b in borders if b <= here + capacity)
        return here == total

    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    latest = {shards: total}
    for k in range(shards - 1, 0, -1):
        latest[k] = min(b for b in borders if b >= latest[k + 1] - low)
    cuts = [0]
    for k in range(1, shards):
        here = cuts[-1]
        share = max(b for b in borders if b <= here + -(-(total - here) // (shards - k + 1)))
        if share == here < total:
            share = min(b for b in borders if b > here)
        cuts.append(max(share, latest[k]))
    return cuts[1:], low


def plain(rows, shards=24):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(hashlib.sha256((text or "").encode()).digest(), []).append((doc_id, text))
    order = sorted(groups)
    size = lambda t: len((t or "").encode()) + 8
    cuts, capacity = plain_cuts([sum(size(t) for _, t in groups[g]) for g in order], shards)
    out, at, slots = [], 0, {}
    for g in order:
        shard = sum(c <= at for c in cuts)
        for doc_id, text in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0)):
            slot = slots[shard] = slots.get(shard, -1) + 1
            out.append((doc_id, size(text), zlib.crc32((text or "").encode()), "bytes", shard, slot, None))
            at += size(text)
    return out, capacity


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[4], r[5]))


def check_law(rows, capacity, shards=24):
    filled = {}
    for r in rows:
        filled[r[4]] = filled.get(r[4], 0) + r[1]
    assert max(filled.values()) <= capacity
    assert set(filled) <= set(range(shards))


def test_query_equals_the_plain_version(spark, sf_dir, texts):
    want, capacity = plain(texts)
    df = QUERIES["op13_sharding"](spark, sf_dir)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = rows_of(df)
    assert [(r[0] is None, r) for r in got] == [(r[0] is None, r) for r in sorted(want, key=lambda r: (r[4], r[5]))]
    check_law(got, capacity)


@pytest.mark.parametrize("cells", [8, 200])
@pytest.mark.parametrize("shape", ["even", "giant", "few", "two giants"])
def test_cuts_found_through_coarse_cells(spark, shape, cells):
    rng = random.Random(len(shape))
    sizes = [rng.randint(8, 900) for _ in range(5 if shape == "few" else 400)]
    if shape == "giant":
        sizes[250] = 2 * sum(sizes)
    if shape == "two giants":
        sizes[1] = sizes[390] = sum(sizes) // 3
    starts, total = [], 0
    for s in sizes:
        starts.append((total,))
        total += s
    df = spark.createDataFrame(starts, "at long")
    want, capacity = plain_cuts(sizes, 24)
    assert sharding.find_cuts(df, total, 24, cells) == want
    borders = [0, *want, total]
    assert max(b - a for a, b in zip(borders, borders[1:])) <= capacity


def test_a_third_of_all_rows_is_one_text(spark):
    rows = [(i, "the same") for i in range(300)] + [(i, f"text {i} " + "x" * (i % 90)) for i in range(600)]
    got = rows_of(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))
    want, capacity = plain(rows)
    assert got == sorted(want, key=lambda r: (r[4], r[5]))
    check_law(got, capacity)
    copies = zlib.crc32(b"the same")
    assert len({r[4] for r in got if r[2] == copies}) == 1


def test_awkward_rows(spark, awkward):
    clash = {c: F.lit(f"{c}!") for c in "row id tie digest part place at number opens bytes".split()}
    docs = awkward.unionByName(awkward.where("doc_id = 8")).unionByName(
        awkward.where("doc_id IN (0, 5)").withColumn("doc_id", F.lit(None).cast("long"))
    ).withColumns(clash)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, _ = plain(rows)
    assert rows_of(sharding.shard(docs)) == sorted(want, key=lambda r: (r[4], r[5]))
    # Nulls and empty texts are one group; carried columns come along.
    carried = sharding.shard(docs, ["doc_id", "lang", "id", "at"])
    assert carried.columns[:4] == ["doc_id", "lang", "id", "at"]
    assert carried.where("id = 'id!' AND at = 'at!'").count() == len(rows)
    assert sharding.shard(spark.createDataFrame([], fixtures.SCHEMA)).count() == 0


def test_fewer_groups_than_shards(spark):
    rows = [(1, "a"), (2, "bb"), (3, None)]
    got = rows_of(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")))
    want, _ = plain(rows)
    assert got == sorted(want, key=lambda r: (r[4], r[5]))
