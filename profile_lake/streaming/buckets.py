"""State by bucket of keys.

A group of ``transformWithStateInPandas`` costs milliseconds, whatever its size: a frame in
and out, and a call to the state store's process for every value and timer. Grouped by
bucket, a micro-batch pays that once per bucket it meets, and reads and writes a bucket's
state as lists. What is decided about a key is the same.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

#: A bucket is held by one task at a time. The number is part of every checkpoint.
BUCKETS = 1024
BUCKET = "_bucket"

LAST_SCHEMA = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("at", T.LongType())])


def bucket(*keys: str | Column) -> Column:
    """The bucket of a key; rows of one key share it."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET)


class HeldRows:
    """Rows of a bucket in list state; written when they changed."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, schema: T.StructType) -> None:
        self._state = handle.getListState(name, schema)

    def read(self) -> list[tuple]:
        return [tuple(row) for row in self._state.get()] if self._state.exists() else []

    def write(self, rows: list[tuple], before: list[tuple]) -> None:
        if rows == before:
            return
        if rows:
            self._state.put(rows)
        else:
            self._state.clear()


class LastAccepted:
    """The last accepted instant of every id of a bucket, until its TTL is over."""

    def __init__(self, handle: StatefulProcessorHandle) -> None:
        self._held = HeldRows(handle, "last", LAST_SCHEMA)

    def read(self) -> dict[str | None, int]:
        self._before = self._held.read()
        return dict(self._before)

    def write(self, last: dict[str | None, int]) -> None:
        self._held.write(list(last.items()), self._before)

    def begin(self, rows: pd.DataFrame) -> int:
        """Add the entries of an initial state; returns the least instant held."""
        last = self.read()
        for query_id, at in zip(rows["query_id"].tolist(), rows["first_seen_us"].tolist()):
            last[query_id] = max(int(at), last.get(query_id, int(at)))
        self.write(last)
        return min(last.values())


def set_timer(handle: StatefulProcessorHandle, wakes: Iterable[int]) -> None:
    """One timer for the bucket, just after the least of some instants in µs."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    least = min(wakes, default=None)
    if least is not None:
        handle.registerTimer(least // 1000 + 1)


def open_rows(frame: pd.DataFrame, clock: str, last: dict[str | None, int], ttl_us: int) -> pd.DataFrame:
    """Rows that no accepted instant of their id suppresses."""
    if not last:
        return frame
    pairs = zip(frame["query_id"].tolist(), frame[clock].tolist())
    return frame[[q not in last or at - last[q] > ttl_us for q, at in pairs]]
