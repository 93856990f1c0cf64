import json
import os

import pytest
from pyspark.sql import functions as F

from profile_lake.functions import partition_keys, rfc3339_from_millis
from profile_lake.operators import metrics, progress
from profile_lake.schemas import PARTITION_COLUMNS, PROFILE_SCHEMA
from profile_lake.sinks import (
    FallbackWriter,
    read_fallback,
    read_flush_log,
    sink_for,
    to_jsonl,
    write_profiles,
    write_records,
)
from profile_lake.sources import read_damaged, read_profiles
from profile_lake.sources.profiles import decode_lines

FLUSH_US = 1736951422 * 1_000_000  # 2025-01-15T14:30:22Z


def record(number, query_hash="h", text="plain", ms=22000.0):
    return (
        "2025-01-15T14:30:22Z", "fe-0:8030", "main", f"q{number}", "FINISHED", "mydb", "root",
        "2025-01-15T14:30:00Z", "2025-01-15T14:30:22Z", ms, "SELECT 1", query_hash, text,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def test_lines_leave_out_an_empty_hash(spark):
    with_hash, without = (
        json.loads(r.value) for r in to_jsonl(frame(spark, [record(1), record(2, None, ms=22000.5)])).collect()
    )
    assert list(with_hash) == PROFILE_SCHEMA.fieldNames()
    assert len(without) == 12 and "query_hash" not in without
    assert without["duration_ms"] == 22000.5


def test_special_characters_survive(spark):
    text = 'quote " and \\ and\nnewline\tand tab, é, <>&'
    rows = frame(spark, [record(1, text=text)])
    assert decode_lines(to_jsonl(rows)).collect() == rows.collect()


def test_flush_goes_to_one_folder_in_order(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = frame(spark, [record(1), record(2)]).coalesce(1)
    write_profiles(rows, path, FLUSH_US)
    folder = os.path.join(path, "year=2025", "month=01", "day=15", "hour=14")
    files = [f for f in os.listdir(folder) if f.endswith(".json")]
    assert len(files) == 1
    with open(os.path.join(folder, files[0])) as lines:
        assert [json.loads(line)["sr_query_id"] for line in lines] == ["q1", "q2"]
    back = read_profiles(spark, path)
    assert back.select(*PROFILE_SCHEMA.fieldNames()).orderBy("sr_query_id").collect() == rows.collect()
    assert tuple(back.select(*PARTITION_COLUMNS).first()) == ("2025", "01", "15", "14")


def test_files_are_limited_and_folders_pruned(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = frame(spark, [record(i) for i in range(25)]).coalesce(1)
    write_profiles(rows, path, FLUSH_US, batch_size=10, even_files=False)
    write_profiles(rows, path, FLUSH_US + 3_600_000_000)
    folder = os.path.join(path, "year=2025", "month=01", "day=15", "hour=14")
    assert len([f for f in os.listdir(folder) if f.endswith(".json")]) == 3
    one = read_profiles(spark, path).where("month = '01' and hour = '15'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert one.count() == 25


def test_backends():
    assert sink_for({"bucket": "b", "prefix": "/p/"}).location == "gs://b/p"
    s3 = sink_for({"backend": "s3", "bucket": "b", "prefix": "p", "region": "r", "endpoint": "http://e"})
    assert s3.location == "s3a://b/p"
    assert s3.hadoop_options == {
        "fs.s3a.endpoint.region": "r", "fs.s3a.endpoint": "http://e", "fs.s3a.path.style.access": "true",
    }
    assert sink_for({"backend": "s3", "bucket": "b"}).hadoop_options == {}
    assert sink_for({"backend": "file", "output_dir": "/data/", "prefix": "p"}).location == "/data/p"
    console = sink_for({"backend": "stdout", "batch_size": 50})
    assert (console.location, console.batch_size) == (None, 50)
    assert sink_for({"backend": "file"}).batch_size is None


@pytest.mark.parametrize("options", [{}, {"backend": "s3"}, {"backend": "gcs", "bucket": ""}, {"backend": "ftp"}])
def test_bad_options(options):
    with pytest.raises(ValueError):
        sink_for(options)


def test_records_go_where_the_sink_says(spark, tmp_path, capsys):
    rows = frame(spark, [record(i) for i in range(60)])
    write_records(rows, sink_for({"backend": "stdout", "batch_size": 50}), FLUSH_US)
    printed = [json.loads(line)["sr_query_id"] for line in capsys.readouterr().out.splitlines()]
    assert sorted(printed) == sorted(f"q{i}" for i in range(60))
    sink = sink_for({"backend": "file", "output_dir": str(tmp_path), "prefix": "p"})
    write_records(rows, sink, FLUSH_US)
    assert read_profiles(spark, str(tmp_path / "p")).count() == 60


def flushed(spark, place, fallback):
    """Ids in the table and in the fallback, and the table's folders."""
    table = read_profiles(spark, place)
    kept = read_fallback(spark, fallback)
    return (
        sorted(r.sr_query_id for r in table.collect()),
        sorted((r.sr_query_id, r.batch_id) for r in kept.collect()),
        {tuple(r) for r in table.select(*PARTITION_COLUMNS).distinct().collect()},
    )


def test_repeats_over_the_hour_replace_and_success_clears_the_fallback(spark, tmp_path):
    blocked = tmp_path / "blocked"
    blocked.write_text("a file where the table should be")
    fallback, log, table = str(tmp_path / "fallback"), str(tmp_path / "log"), str(tmp_path / "table")
    late = FLUSH_US - FLUSH_US % 3_600_000_000 + 3_599_000_000  # 14:59:59
    now = [late]
    rows = frame(spark, [record(1), record(2)])
    failing = FallbackWriter(str(blocked / "t"), fallback, log, lambda: now[0])
    good = FallbackWriter(table, fallback, log, lambda: now[0])
    failing(rows, 6)
    failing(rows, 7)
    good(rows, 8)
    now[0] += 5_000_000  # 15:00:04
    good(rows, 8)
    good(frame(spark, [record(9)]), 7)
    ids, kept, folders = flushed(spark, table, fallback)
    assert ids == ["q1", "q2", "q9"]
    assert kept == [("q1", 6), ("q2", 6)]
    assert folders == {("2025", "01", "15", "14")}
    flushes = read_flush_log(spark, log)
    size = metrics.encoded_bytes(to_jsonl(frame(spark, [record(1), record(2), record(9)]))).first().bytes
    totals = metrics.flush_totals(flushes).first()
    assert (totals.bytes_written_total, totals.fallback_writes_total) == (size, 2)
    counts = {r.status: r.flushes_total for r in metrics.flushes_by_status(flushes).collect()}
    assert counts == {"success": 2, "error": 1}


def test_a_failing_batch_is_no_failure_of_the_store(spark, tmp_path):
    broken = frame(spark, [record(1)]).withColumn("state", F.raise_error(F.lit("no state")).cast("string"))
    writer = FallbackWriter(str(tmp_path / "t"), str(tmp_path / "f"), str(tmp_path / "l"), lambda: FLUSH_US)
    with pytest.raises(Exception, match="no state"):
        writer(broken, 1)
    assert not (tmp_path / "f").exists()


def test_damaged_lines_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "table")
    write_profiles(frame(spark, [record(1)]), path, FLUSH_US)
    folder = tmp_path / "table" / "year=2025" / "month=01" / "day=15" / "hour=14"
    (folder / "part-x.json").write_text('{"ts": "2025"\n')
    assert [r.sr_query_id for r in read_profiles(spark, path).collect()] == ["q1"]
    assert [(r.value, r.hour) for r in read_damaged(spark, path).collect()] == [('{"ts": "2025"', "14")]


def test_progress_versions(spark, tmp_path):
    path = str(tmp_path / "progress")
    marks, version = progress.load_progress(spark, path)
    assert (marks.count(), version) == (0, -1)
    for number in range(2):
        new = spark.createDataFrame([("h", 10 + number)], progress.PROGRESS_SCHEMA)
        progress.save_progress(new, path, number)
    # A version without its success marker is still being written.
    os.makedirs(os.path.join(path, "version=2"))
    marks, version = progress.load_progress(spark, path)
    assert (version, [tuple(r) for r in marks.collect()]) == (1, [("h", 11)])


def test_times_do_not_depend_on_the_session_zone(spark):
    millis = [1710037800000, 1720000000999, 0, -1]
    df = spark.createDataFrame([(m,) for m in millis], "ms long")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [r[0] for r in df.select(rfc3339_from_millis("ms")).collect()]
        keys = df.limit(1).select(*partition_keys(F.col("ms") * 1000)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-03-10T02:30:00Z", "2024-07-03T09:46:40Z", "", ""]
    assert tuple(keys) == ("2024", "03", "10", "02")
