"""Whole runs: two polls in turn, and the outcomes around them."""

import hashlib
import json

from profile_lake.operators.metrics import collected_by_host, skipped_by_reason
from profile_lake.plans.collect import collect
from profile_lake.schemas import MICROS, PROFILE_SCHEMA

from tests.helpers import ARRIVAL, empty_state, listed, listing, profile, responses

NOW = ARRIVAL + 30 * MICROS


def run(spark, rows, seen, progress):
    return collect(responses(spark, rows), seen, progress, "lab", NOW)


def test_two_runs(spark):
    seen, progress = empty_state(spark)
    listed_rows = [
        listed("alpha", 70, sql="SELECT price FROM goods"),
        listed("beta", 80, start_ms=1_735_689_061_500, latency=4000, user="bob", sql=""),
        listed("gamma", 90, state="RUNNING", latency=-1),
    ]
    rows = [listing(1, "n1:8030", listed_rows, at=ARRIVAL)]
    rows += [profile(1, "n1:8030", q, f"plan of {q}") for q in ("alpha", "beta")]
    first = run(spark, rows, seen, progress)
    got = [r.asDict() for r in first.records.orderBy("sr_query_id").collect()]
    assert first.records.columns == PROFILE_SCHEMA.fieldNames()
    same = {"ts": "2025-01-01T00:00:30Z", "fe_host": "n1:8030", "cluster": "lab", "state": "FINISHED", "database": "shop"}
    assert got == [
        {
            **same, "sr_query_id": "alpha", "user": "ann", "start_time": "2024-12-31T23:50:00Z",
            "end_time": "2024-12-31T23:50:00Z", "duration_ms": 250.0, "sql_text": "SELECT price FROM goods",
            "query_hash": hashlib.md5(b"SELECT price FROM goods").hexdigest(), "profile_text": "plan of alpha",
        },
        {
            **same, "sr_query_id": "beta", "user": "bob", "start_time": "2024-12-31T23:51:01Z",
            "end_time": "2024-12-31T23:51:05Z", "duration_ms": 4000.0, "sql_text": "", "query_hash": None,
            "profile_text": "plan of beta",
        },
    ]
    assert [tuple(r) for r in first.progress.collect()] == [("n1:8030", 90)]
    assert sorted(r.query_id for r in first.seen.collect()) == ["alpha", "beta"]

    # Without the mark the same listing comes again, and both ids are known.
    again = run(spark, rows, first.seen, progress)
    assert again.records.count() == 0
    assert [tuple(r) for r in skipped_by_reason(again.outcomes).collect()] == [("dedup", 2)]
    # With the mark there is nothing new to look at.
    later = run(spark, rows, first.seen, first.progress)
    assert later.outcomes.count() == 0
    assert [tuple(r) for r in later.progress.collect()] == [("n1:8030", 90)]


def test_no_id_twice_within_its_ttl_however_many(spark):
    seen, progress = empty_state(spark)
    ids = [f"q{i}" for i in range(30)]
    first = run(spark, [listing(1, "a", [listed(q, 1) for q in ids])], seen, progress)
    again = run(spark, [listing(2, "b", [listed(q, 2) for q in ids], at=ARRIVAL + MICROS)], first.seen, progress)
    assert {r.outcome for r in again.outcomes.collect()} == {"dedup"}


def entry(query_id, event_time, state="FINISHED"):
    return {"queryId": query_id, "eventTime": event_time, "state": state, "sql": "S"}


def test_outcomes_marks_and_dead_letters(spark):
    seen, progress = empty_state(spark)
    rows = [
        # host a: q1 kept, its repeat dropped, q2 has no profile, q3's fetch failed twice
        listing(1, "a", [entry("q1", 10), entry("q1", 11), entry("q2", 50), entry("q3", 60)]),
        profile(1, "a", "q1", "text"),
        profile(1, "a", "q2", status=404),
        profile(1, "a", "q3", status=500, attempt=1),
        profile(1, "a", "q3", status=503, attempt=2),
        # host b: first attempt failed, second counts; q1 again, an unanswered fetch
        listing(1, "b", "boom", status=500, attempt=1, at=NOW - 500_000),
        listing(1, "b", {"data": [entry("q1", 20), entry("q4", 30), entry("", 25)]}, attempt=2, at=NOW - 400_000),
        # host c: unreadable; host d: refused
        listing(1, "c", "not json"),
        listing(1, "d", "no", status=403),
        # host e: only a failed fetch, so no mark
        listing(1, "e", [entry("q5", 99)]),
        profile(1, "e", "q5", status=404),
    ]
    got = run(spark, rows, seen, progress)
    outcomes = {(r.fe_host, r.query_id, r.event_time): r.outcome for r in got.outcomes.collect()}
    assert outcomes == {
        ("a", "q1", 10): "collected", ("a", "q1", 11): "dedup", ("a", "q2", 50): "not_found",
        ("a", "q3", 60): "fetch_error", ("b", "q1", 20): "dedup", ("b", "q4", 30): "fetch_error",
        ("b", "", 25): "unfinished", ("e", "q5", 99): "not_found",
    }
    assert [(r.sr_query_id, r.profile_text) for r in got.records.collect()] == [("q1", "text")]
    assert {r.fe_host: r.last_event_time for r in got.progress.collect()} == {"a": 11, "b": 25}
    # Ids whose fetch failed stay marked.
    assert sorted(r.query_id for r in got.seen.collect()) == ["q1", "q2", "q3", "q4", "q5"]
    assert [bytes(r.body) for r in got.bad.collect()] == [b"not json"]
    polled = {r.fe_host: r.ok for r in got.polls.collect()}
    assert polled == {"a": True, "b": True, "c": False, "d": False, "e": True}
    assert {r.reason: r.profiles_skipped_total for r in skipped_by_reason(got.outcomes).collect()} == {
        "dedup": 2, "not_found": 2, "fetch_error": 2,
    }
    assert [tuple(r) for r in collected_by_host(got.outcomes).collect()] == [("a", 1)]


def test_running_row_does_not_mark_its_id(spark):
    seen, progress = empty_state(spark)
    rows = [
        listing(1, "a", [entry("q", 1, "RUNNING")], at=NOW - 6_000_000),
        listing(2, "a", [entry("q", 2)], at=NOW - 1_000_000),
        profile(2, "a", "q", "done"),
    ]
    got = run(spark, rows, seen, progress)
    assert [r.profile_text for r in got.records.collect()] == ["done"]


def test_plan_keeps_bodies_out_of_early_shuffles(spark, tmp_path):
    seen, progress = empty_state(spark)
    rows = [listing(1, "a", json.dumps([entry("q", 1)])), profile(1, "a", "q", "done")]
    path = str(tmp_path / "landed")
    responses(spark, rows).write.parquet(path)
    got = collect(spark.read.parquet(path), seen, progress, "c", NOW)
    plan = got.records._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # Staged outcomes and one scan of bodies, whose texts move in the final join only.
    assert len(scans) == 2
    assert sum("body#" in line for line in scans) == 1
