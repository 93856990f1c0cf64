"""The commit log: whole batches or nothing, repeats, time ranges, removal of old tries."""

import os
import time

import pytest

from profile_lake.schemas import PARTITION_COLUMNS, PROFILE_SCHEMA
from profile_lake.sinks import commits, write_profiles
from profile_lake.sources import read_profiles

HOUR = 3_600_000_000
FLUSH_US = 1736951422 * 1_000_000  # 2025-01-15T14:30:22Z


def records(spark, *numbers, ts="2025-01-15T14:30:22Z"):
    rows = [
        (ts, "fe-0:8030", "main", f"q{n}", "FINISHED", "mydb", "root", ts, ts, 22000.0, "SELECT 1", "h", "text")
        for n in numbers
    ]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def ids(spark, path, *times):
    return sorted(r.sr_query_id for r in read_profiles(spark, path, *times).collect())


def test_a_reader_sees_a_batch_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.publish_batch(records(spark, 1), path, FLUSH_US, "0")
    added = commits.add_files(records(spark, 2, 3).repartition(2), path, FLUSH_US, "1", batch_size=1)
    assert ids(spark, path) == ["q1"]
    # A try that died while its version was written: files, no marker.
    lost = tmp_path / "t" / "_commits" / "version=1"
    lost.mkdir()
    (lost / "part-0.json").write_text('{"batch":"1","folder":"year=2025/nowhere"')
    assert ids(spark, path) == ["q1"]
    assert commits.commit(spark, path, added) == 1
    assert ids(spark, path) == ["q1", "q2", "q3"]


def test_a_repeat_replaces_and_running_readers_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.publish_batch(records(spark, 1, 2), path, FLUSH_US, "0")
    before = read_profiles(spark, path)
    commits.publish_batch(records(spark, 2, 3), path, FLUSH_US, "0")
    assert sorted(r.sr_query_id for r in before.collect()) == ["q1", "q2"]
    assert ids(spark, path) == ["q2", "q3"]
    assert commits.committed_folders(spark, path, version=0) != commits.committed_folders(spark, path)
    assert commits.remove_unnamed(spark, path) == 0  # too young
    old = time.time() - 2 * 86400
    for folder, _, _ in os.walk(path):
        os.utime(folder, (old, old))
    assert commits.remove_unnamed(spark, path) == 1
    assert ids(spark, path) == ["q2", "q3"]


def test_long_logs_are_folded_and_give_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE_EVERY", 3)
    path = str(tmp_path / "t")
    for n in range(8):
        commits.publish_batch(records(spark, n % 5), path, FLUSH_US, str(n % 5))
    assert ids(spark, path) == ["q0", "q1", "q2", "q3", "q4"]
    assert commits.commits(spark, path).count() == 5
    old = time.time() - 2 * 86400
    for folder, _, _ in os.walk(path):
        os.utime(folder, (old, old))
    assert commits.remove_unnamed(spark, path) == 3
    assert commits.versions(spark, path) == [6, 7]
    assert ids(spark, path) == ["q0", "q1", "q2", "q3", "q4"]


def test_empty_batches_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.publish_batch(records(spark), path, FLUSH_US, "0")
    rows = read_profiles(spark, path)
    assert rows.count() == 0 and rows.columns == PROFILE_SCHEMA.fieldNames() + list(PARTITION_COLUMNS)
    commits.publish_batch(records(spark, 1), path, FLUSH_US, "1")
    commits.publish_batch(records(spark), path, FLUSH_US, "1")
    assert ids(spark, path) == []


def test_other_writers_go_through_the_log(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.publish_batch(records(spark, 1), path, FLUSH_US, "0")
    write_profiles(records(spark, 2), path, FLUSH_US + HOUR)
    assert ids(spark, path) == ["q1", "q2"]
    folders = read_profiles(spark, path).select("hour", "sr_query_id").collect()
    assert sorted(map(tuple, folders)) == [("14", "q1"), ("15", "q2")]


@pytest.mark.parametrize("logged", [True, False])
def test_a_range_of_times_prunes_by_itself(spark, tmp_path, logged):
    path = str(tmp_path / "t")
    # The third record was collected just before the hour and flushed after it.
    for n, (ts, flush_us) in enumerate(
        [
            ("2025-01-15T13:10:00Z", FLUSH_US - HOUR),
            ("2025-01-15T14:30:22Z", FLUSH_US),
            ("2025-01-15T14:59:30Z", FLUSH_US + HOUR // 2 - 22_000_000),
            ("2025-01-15T16:30:00Z", FLUSH_US + 2 * HOUR),
        ]
    ):
        if logged:
            commits.publish_batch(records(spark, n, ts=ts), path, flush_us, str(n))
        else:
            write_profiles(records(spark, n, ts=ts), path, flush_us)
    asked = ("2025-01-15T14:00:00Z", "2025-01-15T15:00:00Z")
    assert ids(spark, path, *asked) == ["q1", "q2"]
    assert ids(spark, path, None, asked[0]) == ["q0"]
    assert ids(spark, path, asked[1]) == ["q3"]
    read = read_profiles(spark, path, *asked).inputFiles()
    plan = read_profiles(spark, path, *asked)._jdf.queryExecution().executedPlan().toString()
    assert len(read) == 2 if logged else "PartitionFilters: [(concat_ws(-, year" in plan
