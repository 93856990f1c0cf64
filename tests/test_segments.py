"""The seen set in segments gives the rows of the whole set, and writes what a batch brings."""

import os
import random

import pytest
from pyspark.sql import functions as F

from profile_lake.operators import dedup, segments

TTL = 1000


def frame(spark, rows):
    return spark.createDataFrame(rows, segments.ENTRY_SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "first_seen_us").collect()))


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(segments, "FAN_IN", 3)
    monkeypatch.setattr(segments, "BUCKET_ENTRIES", 8)
    monkeypatch.setattr(segments, "BITS_PER_ENTRY", 8192)


def test_segments_equal_the_whole_set(spark, tmp_path, small):
    state = segments.SeenSegments(spark, str(tmp_path), TTL, kept=3)
    chance = random.Random(3)
    known = frame(spark, [])
    for version in range(11):
        now = 150 * (version + 1)
        ids = chance.sample([f"q{n}" for n in range(60)] + ["", "é" * 50], 13 if version != 5 else 0)
        batch = frame(spark, [(q, now - chance.randrange(140)) for q in ids] + ([("q0", now), ("q0", now - 1)] if version == 2 else []))
        state.add(batch, version, now)
        known = frame(spark, rows_of(dedup.compact_seen(dedup.merge_seen(known, batch, "first_seen_us"), now, TTL)))
        if version % 3 == 2 or version == 10:
            assert rows_of(state.whole(version)) == rows_of(known)
            asked = spark.createDataFrame([(q,) for q in ["q0", "q1", "q1", "q59", "", "new", None]], "query_id string")
            want = known.join(asked.distinct(), "query_id", "left_semi")
            assert rows_of(state.lookup(asked, version)) == rows_of(want)
    found, _ = state.segments(10)
    assert all(sum(s.level == level for s in found) < 3 for level in range(4))
    # A version made again is the same; older ones than the kept are gone with their segments.
    before = rows_of(state.whole(10))
    state.add(batch, 10, now)
    assert rows_of(state.whole(10)) == before
    kept = {s.name for v in range(8, 11) for s in state.segments(v)[0]}
    assert set(os.listdir(tmp_path / "segments")) == kept
    assert not (tmp_path / "manifest" / "version=7").exists()


def test_work_follows_the_batch(spark, tmp_path):
    state = segments.SeenSegments(spark, str(tmp_path), TTL)
    many = spark.range(300_000).select(F.concat(F.lit("old-"), F.col("id")).alias("query_id"), F.lit(5).cast("long").alias("first_seen_us"))
    state.begin(many)
    base = size_of(tmp_path / "segments" / "start")
    for version in range(3):
        ids = [(f"new-{version}-{n}", 10) for n in range(20)]
        state.add(frame(spark, ids), version, 10)
        assert size_of(tmp_path / "segments" / f"{version:09}-0") < base / 100
    found, _ = state.segments(2)
    assert [(s.name, s.entries) for s in found] == [("000000000-0", 20), ("000000001-0", 20), ("000000002-0", 20), ("start", 300_000)]
    # Ids of one young segment open that one alone, but for what a filter errs in.
    asked = frame(spark, [(f"new-1-{n}", 0) for n in range(20)])
    places = state.places(asked, found)
    assert sum("000000001-0" in p for p in places) == 1 and len(places) <= 3
    assert rows_of(state.lookup(asked, 2)) == [(f"new-1-{n}", 10) for n in sorted(range(20), key=str)]
    # Every id of the base is found, and few that are not in it.
    assert state.lookup(many, 2).count() == 300_000
    absent = spark.range(2000).select(F.concat(F.lit("none-"), F.col("id")).alias("query_id"))
    assert state.lookup(absent, 2).count() == 0


def test_expired_segments_go_unread(spark, tmp_path):
    state = segments.SeenSegments(spark, str(tmp_path), TTL, kept=1)
    state.add(frame(spark, [("a", 1)]), 0, 1)
    state.add(frame(spark, [("b", 2000)]), 1, 2000)
    assert [s.name for s in state.segments(1)[0]] == ["000000001-0"]
    state.add(frame(spark, []), 2, 4000)
    assert state.segments(2) == ([], 3000)
    assert rows_of(state.whole(2)) == [] and rows_of(state.lookup(frame(spark, [("a", 0)]), 2)) == []
