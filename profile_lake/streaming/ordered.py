"""The exact TTL rule over a stream whose rows come out of order.

A row is decided when the watermark has passed it: no earlier row of its id can come any
more, so the choice is the batch operator's for all rows within the lateness. What an
accepted instant suppresses is dropped as it comes. Rows the watermark has passed before
they come are decided by what is known then: suppressed if an accepted instant is not
before them or at most a TTL before, else accepted.

State of an id, held with the others of its bucket: its undecided rows, of one instant only
the least, and its last accepted instant until the TTL is over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from profile_lake.streaming.buckets import BUCKET, HeldRows, LastAccepted, bucket, open_rows, set_timer


class _OrderedTtlProcessor(StatefulProcessor):
    def __init__(self, ttl_us: int, order: Sequence[str], schema: T.StructType) -> None:
        self.ttl_us = ttl_us
        self.order = list(order)
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = LastAccepted(handle)
        self.waiting = HeldRows(handle, "waiting", self.schema)
        self.names = self.schema.fieldNames()
        self.at = self.names.index(self.order[0])
        self.id = self.names.index("query_id")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        set_timer(self.handle, [self.last.begin(initialState) + self.ttl_us])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, before = self.last.read(), self.waiting.read()
        held = pd.DataFrame(before, columns=self.names) if before else None
        for frame in rows:
            frame = open_rows(frame[self.names], self.order[0], last, self.ttl_us)
            if frame.empty:
                continue
            both = frame if held is None else pd.concat([held, frame], ignore_index=True)
            held = both.sort_values(["query_id", *self.order], ignore_index=True).drop_duplicates(
                ["query_id", self.order[0]], ignore_index=True
            )
        waiting = [] if held is None else list(held.astype(object).itertuples(index=False, name=None))
        yield from self._decided(waiting, before, last, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before = self.waiting.read()
        yield from self._decided(before, before, self.last.read(), timerValues)

    def close(self) -> None:
        pass

    def _decided(self, waiting: list[tuple], before: list[tuple], last: dict, timerValues) -> Iterator[pd.DataFrame]:
        """Decide what can be decided of ``waiting``, which is in order of time by id."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        out, left, wake = [], [], []
        for row in waiting:
            query_id, at = row[self.id], int(row[self.at])
            if query_id in last and at - last[query_id] <= self.ttl_us:
                continue
            if at < passed:
                out.append(row)
                last[query_id] = at
            else:
                left.append(row)
                wake.append(at)
        last = {q: at for q, at in last.items() if at + self.ttl_us >= passed}
        self.last.write(last)
        self.waiting.write(left, before)
        set_timer(self.handle, [*wake, *[at + self.ttl_us for at in last.values()]])
        if out:
            yield pd.DataFrame(out, columns=self.names)


def ordered_ttl(
    rows: DataFrame,
    ttl_us: int,
    order: Sequence[str] = ("event_us", "fe_host", "event_id"),
    lateness: str = "10 minutes",
    seen: DataFrame | None = None,
) -> DataFrame:
    """The rows of a stream (query_id, ``order``, more) that the batch operator would accept.

    The clock is ``order[0]``, in µs. ``seen`` (query_id, first_seen_us) is the initial state
    of a new checkpoint: it is read once, not joined in every micro-batch. Needs the RocksDB
    state store.
    """
    schema = rows.schema
    clock = F.timestamp_micros(order[0]).alias("_clock")
    # The processor sees every row only if no watermarked column goes in.
    plain = rows.select("*", clock).withWatermark("_clock", lateness).select(*schema.fieldNames())
    initial = None
    if seen is not None:
        initial = seen.select(bucket("query_id"), "query_id", "first_seen_us").groupBy(BUCKET)
    return plain.withColumn(BUCKET, bucket("query_id")).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=_OrderedTtlProcessor(ttl_us, order, schema),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
        initialState=initial,
    )
