"""Streams keep the state of ids by bucket: what a micro-batch costs does not follow the ids."""

import pytest
from pyspark.sql import functions as F

from profile_lake.operators import dedup
from profile_lake.plans.collect import collect
from profile_lake.schemas import MICROS
from profile_lake.sources import stream_responses
from profile_lake.streaming import buckets
from profile_lake.streaming import dedup as stream_dedup
from profile_lake.streaming.marks import read_seen
from profile_lake.streaming.ordered import ordered_ttl
from profile_lake.streaming.outcomes import read_outcomes, run_outcomes

from tests.helpers import ARRIVAL, empty_state, listed, listing, profile, responses
from tests.test_streaming import MINUTE, ROWS, Landing, at, put_rows, run

IDS = [f"q{n}" for n in range(30)]


@pytest.fixture
def few(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKETS", 4)
    stream_dedup.use_rocksdb(spark)


def groups(spark, checkpoint, operator, name):
    state = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name)
    return state.load(checkpoint).select("key").distinct().count()


def test_outcomes_of_many_ids_in_few_buckets(spark, few, tmp_path):
    landing = Landing(tmp_path)
    parts = []
    for n, poll in enumerate((IDS[:20], IDS[10:])):
        arrived = ARRIVAL + n * MICROS
        parts.append(
            [listing(n, "a", [listed(q, 100 * n + k + 1) for k, q in enumerate(poll)], at=arrived)]
            + [profile(n, "a", q, f"text {q}", at=arrived) for q in poll if q != "q3"]
        )
        landing.put(responses(spark, parts[-1]))
    base = str(tmp_path / "out")
    run_outcomes(stream_responses(spark, landing.path, max_files=1), base, "main", lambda: ARRIVAL)
    seen, marks = empty_state(spark)
    batch = collect(responses(spark, sum(parts, [])), seen, marks, "main", ARRIVAL)
    order = lambda df: sorted((r.query_id, r.event_time, r.outcome) for r in df.collect())
    got = order(read_outcomes(spark, base))
    # The text of q3 may come for ten minutes more.
    assert got == [row for row in order(batch.outcomes) if row[0] != "q3"]
    assert [outcome for _, _, outcome in got].count("dedup") == 10
    checkpoint = f"{base}/checkpoint-first"
    assert sorted(r.query_id for r in read_seen(spark, checkpoint).collect()) == sorted(IDS)
    assert groups(spark, checkpoint, 0, "last") <= 4
    assert groups(spark, checkpoint, 1, "requests") <= 4


@pytest.mark.parametrize("shuffled", [False, True])
def test_ttl_of_many_ids_in_few_buckets(spark, few, tmp_path, shuffled):
    landing = Landing(tmp_path)
    rows = [at(minutes, 100 * n + k, q) for n, q in enumerate(IDS) for k, minutes in enumerate((0, 20, 31, 50, 65))]
    for part in (rows[:75:2] + rows[1:75:2], rows[75:]):
        put_rows(spark, landing, part)
    stream, ttl, out, state = landing.stream(spark, ROWS), 30 * MINUTE, str(tmp_path / "out"), str(tmp_path / "state")
    if shuffled:
        put_rows(spark, landing, [at(1440, -1, "end")])
        kept = ordered_ttl(stream, ttl, lateness="2 hours")
    else:
        kept = stream_dedup.exact_ttl(stream_dedup.with_event_ts(stream), ttl, lateness="2 hours")
    run(kept, out, state)
    want = dedup.ttl_dedup(spark.createDataFrame(rows, ROWS), ttl)
    ids = lambda df: sorted(r.event_id for r in df.where("event_id >= 0").collect())
    assert ids(spark.read.parquet(out)) == ids(want) == sorted(100 * n + k for n in range(30) for k in (0, 2, 4))
    assert groups(spark, state, 0, "waiting" if shuffled else "last") <= 4
    assert spark.read.parquet(out).where(F.col("query_id").isNull()).isEmpty()
