"""Builders for landed responses."""

import json

from profile_lake.schemas import LISTING, PROFILE, RESPONSE_SCHEMA

ARRIVAL = 1_735_689_600_000_000  # 2025-01-01 00:00:00


def listed(query_id, event_time, state="FINISHED", start_ms=1_735_689_000_000, latency=250, **more):
    """A row of a listing."""
    row = {
        "queryId": query_id, "eventTime": event_time, "isQuery": True, "state": state, "database": "shop",
        "sql": f"SELECT {query_id}", "user": "ann", "startTime": start_ms, "latency": latency,
        "endTime": start_ms + latency if latency >= 0 else -1, "connId": 9,
    }
    return {**row, **more}


def listing(poll, host, body, status=200, attempt=1, at=ARRIVAL):
    if not isinstance(body, (str, bytes)) and body is not None:
        body = json.dumps(body)
    raw = body.encode() if isinstance(body, str) else body
    return (poll, host, LISTING, None, attempt, status, at, at + 500, raw)


def profile(poll, host, query_id, text="", status=200, attempt=1, at=ARRIVAL):
    return (poll, host, PROFILE, query_id, attempt, status, at, at + 500, text.encode())


def responses(spark, rows):
    return spark.createDataFrame(rows, RESPONSE_SCHEMA)


def empty_state(spark):
    return (
        spark.createDataFrame([], "query_id string, first_seen_us long"),
        spark.createDataFrame([], "fe_host string, last_event_time long"),
    )
