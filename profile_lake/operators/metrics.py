"""Collection counters and histograms as aggregates.

Each is one aggregation with a combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profile_lake.functions.histogram import le_histogram
from profile_lake.schemas import (
    COLLECTED,
    DEDUP,
    ENTRIES_PER_FLUSH_BOUNDS,
    FETCH_ERROR,
    FLUSH_DURATION_BOUNDS,
    MICROS,
    NOT_FOUND,
    POLL_DURATION_BOUNDS,
)


def polls_by_host(polls: DataFrame) -> DataFrame:
    return polls.groupBy("fe_host").agg(F.count(F.lit(1)).alias("polls_total"))


def collected_by_host(outcomes: DataFrame) -> DataFrame:
    return (
        outcomes.where(F.col("outcome") == COLLECTED)
        .groupBy("fe_host")
        .agg(F.count(F.lit(1)).alias("profiles_collected_total"))
    )


def skipped_by_reason(outcomes: DataFrame) -> DataFrame:
    return (
        outcomes.where(F.col("outcome").isin(DEDUP, NOT_FOUND, FETCH_ERROR))
        .groupBy(F.col("outcome").alias("reason"))
        .agg(F.count(F.lit(1)).alias("profiles_skipped_total"))
    )


def poll_durations(polls: DataFrame) -> DataFrame:
    """Histogram of ``duration_us`` in seconds by host."""
    return le_histogram(polls, ["fe_host"], F.col("duration_us"), POLL_DURATION_BOUNDS, MICROS)


def flushes_by_status(flushes: DataFrame) -> DataFrame:
    return flushes.groupBy("status").agg(F.count(F.lit(1)).alias("flushes_total"))


def entries_per_flush(flushes: DataFrame) -> DataFrame:
    done = flushes.where(F.col("status") == "success")
    return le_histogram(done, [], F.col("entries"), ENTRIES_PER_FLUSH_BOUNDS)


def flush_durations(flushes: DataFrame) -> DataFrame:
    """Histogram of ``duration_us`` in seconds over all flushes, failed ones too."""
    return le_histogram(flushes, [], F.col("duration_us"), FLUSH_DURATION_BOUNDS, MICROS)


def flush_totals(flushes: DataFrame) -> DataFrame:
    """Bytes written, time of the last good flush and records sent to the fallback."""
    good = F.col("status") == "success"
    return flushes.agg(
        F.coalesce(F.sum(F.when(good, F.col("bytes"))), F.lit(0)).alias("bytes_written_total"),
        F.max(F.when(good, F.expr("flush_us div 1000000"))).alias("last_flush_timestamp_seconds"),
        F.coalesce(F.sum(F.when(~good, F.col("entries"))), F.lit(0)).alias("fallback_writes_total"),
    )


def encoded_bytes(lines: DataFrame, column: str = "value") -> DataFrame:
    """Size of JSON lines including their newlines."""
    return lines.agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(F.octet_length(column) + F.lit(1)), F.lit(0)).alias("bytes"),
    )
