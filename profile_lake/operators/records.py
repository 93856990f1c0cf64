"""Filters on listed rows, and the projection onto the collected record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profile_lake.functions.columns import duration_ms, fingerprint, rfc3339_from_millis
from profile_lake.schemas import PROFILE_SCHEMA

RECORD_COLUMNS = PROFILE_SCHEMA.fieldNames()


def is_finished() -> Column:
    return (F.col("query_id") != "") & (F.col("state") == "FINISHED")


def finished(details: DataFrame) -> DataFrame:
    """Completed queries with an id. Apply before deduplication: a running row must not
    mark its id as seen."""
    return details.where(is_finished())


def slow(profiles: DataFrame, threshold_ms: float) -> DataFrame:
    return profiles.where(F.col("duration_ms") >= threshold_ms)


def to_record(details: DataFrame, cluster: str, collected_at: Column) -> DataFrame:
    """The record columns; ``profile_text`` is taken along when present.

    ``collected_at`` is the capture time as RFC 3339 text.
    """
    columns = [
        collected_at.alias("ts"),
        F.col("fe_host"),
        F.lit(cluster).alias("cluster"),
        F.col("query_id").alias("sr_query_id"),
        F.col("state"),
        F.col("database"),
        F.col("user"),
        rfc3339_from_millis("start_time_ms").alias("start_time"),
        rfc3339_from_millis("end_time_ms").alias("end_time"),
        duration_ms("latency").alias("duration_ms"),
        F.col("sql_text"),
        fingerprint("sql_text").alias("query_hash"),
    ]
    if "profile_text" in details.columns:
        columns.append(F.col("profile_text"))
    return details.select(*columns)
