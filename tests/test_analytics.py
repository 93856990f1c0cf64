import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from profile_lake.functions import fingerprint
from profile_lake.operators import analytics, metrics, records

SCHEMA = (
    "sr_query_id string, fe_host string, cluster string, `database` string, `user` string,"
    " start_time string, duration_ms double, query_hash string, sql_text string"
)


def run(number, at="2024-03-10T02:30:00Z", ms=1.0, query_hash="x", user="u"):
    return (f"q{number:05}", "h", "c", "d", user, at, float(ms), query_hash, "S")


def test_percentiles_are_exact(spark):
    rng = random.Random(1)
    values = [rng.choice([5, 5, 5, rng.randrange(1, 900)]) for _ in range(777)]
    df = spark.createDataFrame([run(i, ms=v) for i, v in enumerate(values)], SCHEMA)
    got = analytics.duration_trend(df, "hour", ["cluster"]).first()
    want = np.percentile(values, [50, 95, 99])
    assert [got.p50_ms, got.p95_ms, got.p99_ms] == pytest.approx(list(want), abs=1e-9)
    assert (got.runs, got.max_ms) == (777, max(values))
    assert got.avg_ms == pytest.approx(np.mean(values))


def test_percentiles_count_before_the_shuffle(spark):
    df = spark.createDataFrame([run(1)], SCHEMA)
    plan = analytics.duration_trend(df, "day", [])._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange")
    assert "partial_count" in plan[first_exchange:]


@pytest.mark.parametrize(
    "grain, start",
    [
        ("hour", dt.datetime(2024, 3, 10, 2)), ("day", dt.datetime(2024, 3, 10)),
        ("week", dt.datetime(2024, 3, 4)), ("month", dt.datetime(2024, 3, 1)),
    ],
)
def test_periods_do_not_depend_on_the_session_zone(spark, grain, start):
    # 02:30 on that day does not exist in Los Angeles.
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([run(1), run(2, at="")], SCHEMA)
        got = analytics.duration_trend(df, grain, ["cluster"]).collect()
        assert [(r.period, r.runs) for r in got] == [(start, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        analytics.duration_trend(spark.createDataFrame([run(1)], SCHEMA), "fortnight")


def regression_model(rows, trailing):
    out, past = {}, {}
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        before = past.setdefault(r[7], [])
        tail = before[-trailing:]
        out[r[0]] = (before[-1] if before else None, sum(tail) / len(tail) if tail else None)
        before.append(r[6])
    return out


def test_regression_over_blocks_and_minutes(spark):
    rng = random.Random(4)
    rows = [
        run(
            i,
            at=f"2024-01-01T00:{rng.randrange(3):02}:{rng.randrange(60):02}Z",
            ms=rng.randrange(100),
            query_hash=rng.choice(["hot", "hot", "b", "c"]),
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(rows + [run(9999, query_hash=None)], SCHEMA)
    want = regression_model(rows, 7)
    for block in (1, 20, 100_000):
        got = analytics.duration_regression(df, trailing=7, block_rows=block).collect()
        assert len(got) == len(rows)
        for r in got:
            previous, mean = want[r.sr_query_id]
            assert r.previous_ms == previous
            assert r.trailing_avg_ms == (mean if mean is None else pytest.approx(mean))


def test_statement_summary(spark):
    df = spark.createDataFrame(
        [run(1, ms=30, user="a"), run(2, ms=10, user="b"), run(3, ms=60, query_hash="y"),
         run(4, ms=500, query_hash=None)],
        SCHEMA,
    )
    got = {r.query_hash: (r.runs, r.users, r.total_ms, r.share) for r in analytics.statement_summary(df).collect()}
    assert got == {"x": (2, 2, 40.0, 0.4), "y": (1, 1, 60.0, 0.6)}


def test_correlation_does_not_multiply(spark):
    ours = spark.createDataFrame(
        [run(i) for i in range(5)], SCHEMA
    ).withColumn("query_hash", fingerprint("sql_text"))
    other = spark.createDataFrame([("S", 3), ("S", 4), ("", 9), ("T", 1)], "text string, n long")
    got = analytics.correlate(ours, other, "text", "n").collect()
    assert [(r.other_rows, r.other_runs) for r in got] == [(2, 7)] * 5
    both = analytics.correlate_statements(ours, other, "text").collect()
    assert [(r.runs, r.other_rows, r.other_runs) for r in both] == [(5, 2, 2)]
    empty = ours.withColumn("query_hash", F.lit(None).cast("string"))
    assert analytics.correlate(empty, other, "text").count() == 0


def test_top_slow(spark):
    df = spark.createDataFrame([run(i, ms=i % 7) for i in range(30)], SCHEMA)
    got = sorted(r.sr_query_id for r in analytics.top_slow(df, 3).collect())
    assert got == ["q00006", "q00013", "q00020"]
    # Runs that share id, host and second are rows of their own.
    same = spark.createDataFrame([run(1, ms=100), run(1, ms=5), run(2, ms=50)], SCHEMA)
    for k, durations in ((1, [100]), (2, [50, 100])):
        assert sorted(r.duration_ms for r in analytics.top_slow(same, k).collect()) == durations
    texts = spark.createDataFrame([("q00001", "t")], "sr_query_id string, profile_text string")
    assert [r.profile_text for r in analytics.with_texts(analytics.top_slow(same, 1), texts).collect()] == ["t"]
    per = analytics.top_slow_by(df, ["cluster"], 2)
    assert [(r.sr_query_id, r.place) for r in per.orderBy("place").collect()] == [("q00006", 1), ("q00013", 2)]
    assert records.slow(df, 6).count() == 4


def test_histogram_is_cumulative_with_closed_bounds(spark):
    df = spark.createDataFrame(
        [("h", v) for v in (10_000, 10_001, 50_000, 31_000_000)], "fe_host string, duration_us long"
    )
    rows = metrics.poll_durations(df).collect()
    got = {r.le: r.bucket_count for r in rows}
    assert (got["0.01"], got["0.05"], got["30"], got["+Inf"]) == (1, 3, 3, 4)
    assert {(r.sum_value, r.total_count) for r in rows} == {(31.070001, 4)}


def test_totals_of_no_flush(spark):
    schema = "flush_us long, status string, entries long, duration_us long, bytes long"
    got = metrics.flush_totals(spark.createDataFrame([], schema)).first()
    assert tuple(got) == (0, None, 0)
