import glob
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from profile_lake.operators import dedup
from profile_lake.operators.progress import load_progress
from profile_lake.plans.collect import collect
from profile_lake.schemas import MICROS
from profile_lake.session import shared_dir
from profile_lake.sinks import sink_for
from profile_lake.sources import read_profiles, stream_responses
from profile_lake.streaming import dedup as stream_dedup
from profile_lake.streaming.collect import CollectBatches, continuous_records, flush_writer, start_sink
from profile_lake.streaming.enrich import join_late_profiles
from profile_lake.streaming.monitor import LiveCounters, interval_counts, observed

from tests.helpers import empty_state, listing, profile, responses

MINUTE = 60 * MICROS
START = 1704067200 * MICROS  # 2024-01-01 00:00:00
ROWS = "query_id string, event_us long, fe_host string, event_id long"


class Landing:
    """A folder into which one file is put per micro-batch, ten seconds apart."""

    def __init__(self, tmp_path, name="in"):
        self.path = str(tmp_path / name)
        self.made = str(tmp_path / f"{name}-made")
        os.makedirs(self.path)
        self.count = 0

    def put(self, df):
        folder = f"{self.made}/{self.count}"
        df.coalesce(1).write.parquet(folder)
        (part,) = glob.glob(f"{folder}/part-*.parquet")
        target = f"{self.path}/{self.count:04}.parquet"
        shutil.copy(part, target)
        at = 1_700_000_000 + 10 * self.count
        os.utime(target, (at, at))
        self.count += 1

    def stream(self, spark, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def run(rows, out, checkpoint):
    query = flush_writer(rows, checkpoint, None).format("parquet").option("path", out).start()
    query.awaitTermination()


def at(minutes, number, query_id="a"):
    return (query_id, START + int(minutes * MINUTE), "h", number)


def put_rows(spark, landing, rows):
    landing.put(spark.createDataFrame(rows, ROWS))


def test_exact_ttl_over_batches_and_a_restart(spark, tmp_path):
    landing, out, state = Landing(tmp_path), str(tmp_path / "out"), str(tmp_path / "state")
    batches = [
        [at(0, 1), at(5, 2, "b"), at(3, 3)],
        [at(29, 4), at(31, 5), at(35, 6, "b")],
        [at(45, 7), at(61.5, 8), at(66, 9, "b"), at(70, 10, "c")],
        [at(200, 11, "b"), at(100, 12), at(100, 13, "c"), at(100.5, 14, "c")],
    ]
    for rows in batches[:2]:
        put_rows(spark, landing, rows)
    stream = stream_dedup.with_event_ts(landing.stream(spark, ROWS))
    kept = stream_dedup.exact_ttl(stream, 30 * MINUTE).drop("event_ts")
    run(kept, out, state)
    for rows in batches[2:]:
        put_rows(spark, landing, rows)
    run(kept, out, state)
    everything = spark.createDataFrame([r for rows in batches for r in rows], ROWS)
    want = sorted(r.event_id for r in dedup.ttl_dedup(everything, 30 * MINUTE).collect())
    got = sorted(r.event_id for r in spark.read.parquet(out).collect())
    assert got == want
    assert {1, 5, 8, 12} <= set(got)


def test_exact_ttl_continues_from_a_seen_table(spark, tmp_path):
    landing = Landing(tmp_path)
    put_rows(spark, landing, [at(10, 1), at(31, 2), at(10, 3, "b")])
    seen = spark.createDataFrame([("a", START)], "query_id string, first_seen_us long")
    stream = stream_dedup.with_event_ts(landing.stream(spark, ROWS))
    kept = stream_dedup.exact_ttl(stream, 30 * MINUTE, seen=seen).drop("event_ts")
    run(kept, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 3]


def test_built_in_dedup_never_repeats_within_the_ttl(spark, tmp_path):
    landing = Landing(tmp_path)
    for rows in ([at(0, 1), at(1, 2)], [at(20, 3)], [at(29, 4), at(29, 5, "b")]):
        put_rows(spark, landing, rows)
    stream = stream_dedup.with_event_ts(landing.stream(spark, ROWS))
    run(stream_dedup.at_least_ttl(stream, "30 minutes"), str(tmp_path / "out"), str(tmp_path / "state"))
    got = [r.query_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == ["a", "b"]


DETAILS = "fe_host string, query_id string, event_ts timestamp"
TEXTS = "fe_host string, query_id string, profile_ts timestamp, profile_text string"


def ts(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema.replace(f"{column} timestamp", f"{column} long"))
    return df.withColumn(column, F.timestamp_micros(column))


@pytest.mark.parametrize("how", ["inner", "leftOuter"])
def test_late_profiles(spark, tmp_path, how):
    left, right = Landing(tmp_path, "details"), Landing(tmp_path, "texts")

    def detail(*rows):
        left.put(ts(spark, [("h", q, START + m * MINUTE) for q, m in rows], DETAILS, "event_ts"))

    def text(*rows):
        right.put(ts(spark, [("h", q, START + m * MINUTE, "text") for q, m in rows], TEXTS, "profile_ts"))

    # "a" gets its text two micro-batches later, "b" too late, "c" never.
    detail(("a", 0), ("b", 0), ("c", 1))
    text(("x", 0))
    detail(("d", 4))
    text(("x", 4))
    detail(("e", 5))
    text(("a", 5), ("b", 11))
    for minutes in (100, 200, 300):
        detail(("f", minutes))
        text(("x", minutes))
    joined = join_late_profiles(
        left.stream(spark, DETAILS), right.stream(spark, TEXTS), 600, "1 minute", how
    )
    run(joined, str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.query_id: r.profile_text for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["a"] == "text"
    if how == "inner":
        assert got == {"a": "text"}
    else:
        assert {q: got[q] for q in "bcde"} == {"b": None, "c": None, "d": None, "e": None}


def polls():
    """Three polls of two hosts; the second lists ids again, q3 has no profile."""
    def entry(query_id, number, state="FINISHED"):
        return {"queryId": query_id, "eventTime": number, "state": state, "sql": f"S {query_id}",
                "startTime": 1704067200000, "endTime": 1704067201000, "latency": 1000}

    def poll(number, host, entries, found):
        arrived = START + number * 5 * MICROS
        rows = [listing(number, host, [entry(*e) for e in entries], at=arrived)]
        rows += [profile(number, host, q, f"profile {q}", at=arrived + 1000) for q in found]
        return rows

    return [
        poll(1, "a", [("q1", 1), ("q2", 2), ("run", 3, "RUNNING")], ["q1", "q2"])
        + poll(1, "b", [("q4", 1)], ["q4"]),
        poll(2, "a", [("q1", 4), ("run", 5)], ["run"]) + poll(2, "b", [("q2", 2)], []),
        poll(3, "a", [("q3", 6), ("q1", 7)], []) + poll(3, "b", [("q5", 9)], ["q5"]),
    ]


def test_stream_of_responses_equals_the_batch(spark, tmp_path):
    landing = Landing(tmp_path)
    for rows in polls():
        landing.put(responses(spark, rows))
    stream = stream_responses(spark, landing.path, max_files=1)
    now_us = START + 100 * MICROS
    records = continuous_records(stream, "main", F.lit(now_us))
    sink = sink_for({"backend": "file", "output_dir": str(tmp_path), "prefix": "table"})
    start_sink(records, sink, str(tmp_path / "state"), None).awaitTermination()
    location = sink.location
    got = read_profiles(spark, location)
    seen, progress = empty_state(spark)
    everything = responses(spark, [r for rows in polls() for r in rows])
    batch = collect(everything, seen, progress, "main", now_us)
    columns = batch.records.columns
    want = batch.records.orderBy("sr_query_id").collect()
    assert got.select(*columns).orderBy("sr_query_id").collect() == want
    assert [r.sr_query_id for r in want] == ["q1", "q2", "q4", "q5", "run"]
    assert got.where("year >= '2024'").count() == 5


def test_batches_through_the_batch_pipeline(spark, tmp_path):
    landing = Landing(tmp_path)
    location, state = str(tmp_path / "table"), str(tmp_path / "state")
    collector = CollectBatches(location, state, "main", lambda: START + 100 * MICROS)
    for rows in polls():
        landing.put(responses(spark, rows))
        stream = stream_responses(spark, landing.path, max_files=1)
        query = flush_writer(stream, str(tmp_path / "checkpoint"), None).foreachBatch(collector).start()
        query.awaitTermination()
    got = sorted(r.sr_query_id for r in read_profiles(spark, location).collect())
    assert got == ["q1", "q2", "q4", "q5", "run"]
    marks, version = load_progress(spark, f"{state}/progress")
    assert version == 2
    assert {r.fe_host: r.last_event_time for r in marks.collect()} == {"a": 7, "b": 9}
    # Running a batch again changes nothing.
    before = set(os.listdir(shared_dir(spark)))
    collector(responses(spark, polls()[2]), 2)
    assert read_profiles(spark, location).count() == 5
    # Nothing staged is left behind.
    assert set(os.listdir(shared_dir(spark))) == before
    # A stream with a new checkpoint goes on after the last version.
    more = CollectBatches(location, state, "main", lambda: START + 200 * MICROS, run="second")
    more(responses(spark, polls()[0] + [listing(9, "a", [{"queryId": "q9", "eventTime": 50, "state": "FINISHED"}]),
                                        profile(9, "a", "q9", "late")]), 0)
    assert sorted(r.sr_query_id for r in read_profiles(spark, location).collect()) == ["q1", "q2", "q4", "q5", "q9", "run"]
    assert load_progress(spark, f"{state}/progress")[1] == 3


def test_a_repeat_over_the_hour_replaces_its_records(spark, tmp_path):
    now = [START + 3_599 * MICROS]
    collector = CollectBatches(str(tmp_path / "t"), str(tmp_path / "s"), "main", lambda: now[0])
    collector(responses(spark, polls()[0]), 0)
    now[0] += 5 * MICROS
    collector(responses(spark, polls()[0]), 0)
    table = read_profiles(spark, str(tmp_path / "t"))
    assert sorted(r.sr_query_id for r in table.collect()) == ["q1", "q2", "q4"]
    assert table.select("hour").distinct().count() == 1
    # What became of each row, and the polls, are kept too.
    outcomes = spark.read.parquet(str(tmp_path / "s" / "outcomes"))
    assert sorted(r.outcome for r in outcomes.collect()) == ["collected"] * 3 + ["unfinished"]
    assert spark.read.parquet(str(tmp_path / "s" / "polls")).count() == 2


def test_answers_of_two_attempts_count_once(spark, tmp_path):
    landing = Landing(tmp_path)
    row = {"queryId": "q1", "eventTime": 1, "state": "FINISHED"}
    landing.put(responses(spark, [
        listing(1, "a", [], status=500, attempt=3, at=START), listing(1, "a", [row], attempt=4, at=START + 1000),
        profile(1, "a", "q1", "text", attempt=1, at=START + 2000),
    ]))
    landing.put(responses(spark, [profile(1, "a", "q1", "text", attempt=2, at=START + 3000)]))
    stream = stream_responses(spark, landing.path, max_files=1)
    out = str(tmp_path / "out")
    run(continuous_records(stream, "main", F.lit(START)), out, str(tmp_path / "state"))
    assert [r.profile_text for r in spark.read.parquet(out).collect()] == ["text"]


def test_interval_counts(spark, tmp_path):
    landing = Landing(tmp_path)
    schema = "fe_host string, outcome string, event_us long"
    landing.put(spark.createDataFrame(
        [("h", "collected", START), ("h", "dedup", START + MINUTE), ("h", "collected", START + 6 * MINUTE)],
        schema,
    ))
    landing.put(spark.createDataFrame([("h", "collected", START + 60 * MINUTE)], schema))
    rows = landing.stream(spark, schema).withColumn("event_ts", F.timestamp_micros("event_us"))
    counts = interval_counts(rows).select(
        F.unix_micros("interval.start").alias("start"), "fe_host", "collected", "skipped"
    )
    run(counts, str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # The last interval stays open until the watermark passes it.
    assert got == [(START, "h", 1, 1), (START + 5 * MINUTE, "h", 1, 0)]


def test_live_counters(spark, tmp_path):
    landing = Landing(tmp_path)
    put_rows(spark, landing, [at(0, 1), at(0, 2, "")])
    put_rows(spark, landing, [at(1, 3)])
    counters = LiveCounters()
    spark.streams.addListener(counters)
    try:
        rows = observed(landing.stream(spark, ROWS))
        run(rows, str(tmp_path / "out"), str(tmp_path / "state"))
        for _ in range(100):
            if counters.batches == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    assert counters.totals == {"rows": 3, "without_id": 1}
    assert counters.recent


def test_console_takes_a_stream(spark, tmp_path):
    landing = Landing(tmp_path)
    landing.put(responses(spark, polls()[0]))
    records = continuous_records(stream_responses(spark, landing.path), "main", F.lit(START))
    query = start_sink(records, sink_for({"backend": "stdout"}), str(tmp_path / "state"), None)
    query.awaitTermination()
    assert query.exception() is None
