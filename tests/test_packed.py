"""Records of an id stay side by side, and files may be packed."""

import glob

import pytest
from pyspark.sql import functions as F

from profile_lake.schemas import PROFILE_SCHEMA
from profile_lake.sinks import FallbackWriter, read_fallback, write_profiles
from profile_lake.sinks.commits import publish_batch
from profile_lake.sources import read_profiles

FLUSH = 1736951422 * 1_000_000


@pytest.fixture
def apart(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def records(spark):
    values = {
        "sr_query_id": "concat('q', id % 20)",
        "profile_text": "repeat(sha2(cast(id % 20 AS string), 512), 20)",
        "duration_ms": "cast(id AS double)",
    }
    columns = [f"{values.get(f.name, repr(f.name))} AS {f.name}" for f in PROFILE_SCHEMA]
    return spark.range(400).repartition(4).selectExpr(*columns)


def check(spark, rows):
    rows = rows.withColumn("file", F.input_file_name())
    assert rows.count() == 400
    files = rows.groupBy("sr_query_id").agg(F.countDistinct("file").alias("n"))
    assert {r.n for r in files.collect()} == {1}


def names(path):
    return glob.glob(f"{path}/**/part-*", recursive=True)


def test_appended_records(spark, apart, tmp_path):
    path = str(tmp_path / "table")
    write_profiles(records(spark), path, FLUSH, compression="gzip")
    check(spark, read_profiles(spark, path))
    assert all(name.endswith(".json.gz") for name in names(path))


def test_committed_records(spark, apart, tmp_path):
    path = str(tmp_path / "table")
    publish_batch(records(spark), path, FLUSH, "1", compression="gzip")
    check(spark, read_profiles(spark, path))
    assert all(name.endswith(".json.gz") for name in names(f"{path}/year=2025"))


def test_flushed_records(spark, apart, tmp_path):
    for store in (f"{tmp_path}/table", "unreachable://store/table"):
        FallbackWriter(store, f"{tmp_path}/kept", f"{tmp_path}/log", lambda: FLUSH, compression="gzip")(records(spark), 1)
    check(spark, read_profiles(spark, f"{tmp_path}/table"))
    assert read_fallback(spark, f"{tmp_path}/kept").count() == 400
    assert all(name.endswith(".json.gz") for name in names(f"{tmp_path}/kept"))
