"""The collected table: JSON lines under year=/month=/day=/hour= folders."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profile_lake.functions.columns import rfc3339_to_timestamp
from profile_lake.schemas import FLUSH_INTERVAL_SECONDS, PARTITION_COLUMNS, PROFILE_SCHEMA
from profile_lake.sinks.commits import committed_folders, has_commits

TABLE_SCHEMA = T.StructType(
    PROFILE_SCHEMA.fields + [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
)


def read_profiles(
    spark: SparkSession,
    path: str,
    ts_from: str | None = None,
    ts_to: str | None = None,
    interval_seconds: int = FLUSH_INTERVAL_SECONDS,
) -> DataFrame:
    """Scan with the declared schema; filters on the partition columns prune folders.

    ``ts_from <= ts < ts_to`` (RFC 3339, as in the records) limits the records and prunes by
    itself. A table with a commit log is read as of its last commit, and only commits whose
    range of ``ts`` meets the asked one are listed. In other tables folders are named after
    the flush time, at most ``interval_seconds`` after the record's own, so the range of
    folders is widened by that.
    """
    rows = lines_read(spark, path, ts_from, ts_to).where(F.col("_unread").isNull()).drop("_unread")
    if ts_from is not None:
        rows = rows.where(F.col("ts") >= ts_from)
    if ts_to is not None:
        rows = rows.where(F.col("ts") < ts_to)
    if (ts_from is None and ts_to is None) or has_commits(spark, path):
        return rows
    if ts_from is not None:
        rows = rows.where(_hour() >= _hour_of(ts_from, 0))
    if ts_to is not None:
        rows = rows.where(_hour() <= _hour_of(ts_to, interval_seconds))
    return rows


def _hour() -> Column:
    """The folder's hour as text that sorts by time; made of partition columns only, so it prunes."""
    return F.concat_ws("-", *PARTITION_COLUMNS)


def _hour_of(ts: str, more_seconds: int) -> str:
    at = datetime.fromisoformat(ts).astimezone(timezone.utc) + timedelta(seconds=more_seconds)
    return at.strftime("%Y-%m-%d-%H")


def read_damaged(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the table that are no records: (value, partition columns)."""
    damaged = lines_read(spark, path).where(F.col("_unread").isNotNull())
    return damaged.select(F.col("_unread").alias("value"), *PARTITION_COLUMNS)


def lines_read(spark: SparkSession, path: str, ts_from: str | None = None, ts_to: str | None = None) -> DataFrame:
    """Records, and ``_unread`` with the text of a line that could not be read.

    Of a table with a commit log the files of all commits that may hold ``ts_from <= ts < ts_to``.
    """
    lines = T.StructType([T.StructField("value", T.StringType())] + TABLE_SCHEMA.fields[-len(PARTITION_COLUMNS) :])
    schema = T.StructType(PROFILE_SCHEMA.fields + [T.StructField("_unread", T.StringType())])
    record = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_unread"})
    # The JSON reader refuses queries that need nothing but the unread line.
    paths = committed_folders(spark, path, ts_from, ts_to) if has_commits(spark, path) else [path]
    if not paths:
        rows = spark.createDataFrame([], lines)
    else:
        rows = spark.read.option("basePath", path).schema(lines).text(paths)
    rows = rows.where("value <> ''")
    return rows.select(record.alias("_r"), *PARTITION_COLUMNS).select("_r.*", *PARTITION_COLUMNS)


def with_event_times(profiles: DataFrame) -> DataFrame:
    """Add ``start_ts`` and ``end_ts`` timestamps for analysis."""
    return profiles.withColumns(
        {
            "start_ts": rfc3339_to_timestamp("start_time"),
            "end_ts": rfc3339_to_timestamp("end_time"),
        }
    )


def decode_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines back to records."""
    return lines.select(F.from_json(column, PROFILE_SCHEMA).alias("_r")).select("_r.*")
