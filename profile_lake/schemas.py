"""Schemas and defaults shared by every operator.

The column names, bounds and defaults below are fixed values: files written by
existing collectors, and tables declared over them, depend on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: one row of the query listing ---------------------------------
DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("eventTime", T.LongType()),
        T.StructField("queryId", T.StringType()),
        T.StructField("isQuery", T.BooleanType()),
        T.StructField("state", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("sql", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("startTime", T.LongType()),
        T.StructField("endTime", T.LongType()),
        T.StructField("latency", T.LongType()),
        T.StructField("connId", T.LongType()),
    ]
)

# --- fixed values: the collected record, in output order -------------------------
PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.StringType()),
        T.StructField("fe_host", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("sr_query_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("sql_text", T.StringType()),
        T.StructField("query_hash", T.StringType()),
        T.StructField("profile_text", T.StringType()),
    ]
)
PARTITION_COLUMNS = ["year", "month", "day", "hour"]

# --- ours: raw responses as an external lander writes them -----------------------
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("poll_id", T.LongType()),
        T.StructField("fe_host", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("started_us", T.LongType()),
        T.StructField("finished_us", T.LongType()),
        T.StructField("body", T.BinaryType()),
    ]
)
LISTING = "query_detail"
PROFILE = "profile"

# --- fixed values: limits, defaults and histogram bounds -------------------------
DEDUP_TTL_SECONDS = 1800
BACKOFF_FIRST_SECONDS = 10
BACKOFF_MAX_SECONDS = 300
BACKOFF_FACTOR = 2
FLUSH_INTERVAL_SECONDS = 120
BATCH_SIZE = 1000
POLL_DURATION_BOUNDS = [0.01, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30]
FLUSH_DURATION_BOUNDS = [0.01, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]
ENTRIES_PER_FLUSH_BOUNDS = [1, 5, 10, 25, 50, 100, 250, 500, 1000]

# Outcome of one listed row.
COLLECTED = "collected"
UNFINISHED = "unfinished"
DEDUP = "dedup"
NOT_FOUND = "not_found"
FETCH_ERROR = "fetch_error"

MICROS = 1_000_000
