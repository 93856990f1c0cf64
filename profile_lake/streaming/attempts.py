"""Which response of a request counts, decided while responses stream in.

The rule is that of the batch operator: the earliest final answer (any status but a
retryable one) by attempt number, else the last failed attempt. A final answer decides as
soon as no earlier attempt can still come: at once if the lander keeps a request's attempts
in order, else when all earlier attempts are known or the wait is over. A request without a
final answer is decided when the watermark has passed its wait.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from profile_lake.schemas import MICROS, RESPONSE_SCHEMA
from profile_lake.sources.responses import REQUEST_KEYS, RETRYABLE, response_class
from profile_lake.streaming.buckets import BUCKET, HeldRows, bucket, set_timer

#: How long after a response other attempts of its request may still come.
WAIT_SECONDS = 120

_FIELDS = [f.name for f in RESPONSE_SCHEMA if f.name not in REQUEST_KEYS]
ANSWER_SCHEMA = T.StructType([*RESPONSE_SCHEMA, T.StructField("late", T.BooleanType())])


#: A request as it is held: its key, its best attempt (nulls once it is decided), the attempts
#: seen so far, the latest arrival, and whether it is decided.
_HELD = T.StructType(
    [
        *[RESPONSE_SCHEMA[name] for name in REQUEST_KEYS],
        *[RESPONSE_SCHEMA[name] for name in _FIELDS],
        T.StructField("final", T.BooleanType()),
        T.StructField("attempts", T.StringType()),
        T.StructField("last_us", T.LongType()),
        T.StructField("decided", T.BooleanType()),
    ]
)


class _AttemptProcessor(StatefulProcessor):
    """Holds the best attempt of a bucket's requests and which attempts are known."""

    def __init__(self, wait_us: int, in_order: bool) -> None:
        self.wait_us = wait_us
        self.in_order = in_order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.requests = HeldRows(handle, "requests", _HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.requests.read()
        fresh: dict[tuple, list[dict]] = {}
        for frame in rows:
            for request, row in zip(_requests(frame), _tuples(frame)):
                fresh.setdefault(request, []).append(dict(zip([*_FIELDS, "final"], row)))
        yield from self._settled(before, fresh, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(self.requests.read(), {}, timerValues)

    def close(self) -> None:
        pass

    def _settled(self, before: list[tuple], fresh: dict[tuple, list[dict]], timerValues) -> Iterator[pd.DataFrame]:
        """Decide what can be decided, return it, and forget requests whose wait is over."""
        passed_ms = timerValues.getCurrentWatermarkInMs()
        keys, fields = len(REQUEST_KEYS), len(REQUEST_KEYS) + len(_FIELDS) + 1
        held = {row[:keys]: row for row in before}
        out = []
        for request, rows in fresh.items():
            held_row, answers = self._attempted(held.get(request), rows, passed_ms * 1000)
            out += [(request, *answer) for answer in answers]
            if held_row is not None:
                held[request] = (*request, *held_row)
        kept = []
        for request, row in held.items():
            last_us, decided = row[-2:]
            if (last_us + self.wait_us) // 1000 + 1 > passed_ms:
                kept.append(row)
            elif not decided:
                out.append((request, dict(zip([*_FIELDS, "final"], row[keys:fields])), False))
        self.requests.write(kept, before)
        set_timer(self.handle, [row[-2] + self.wait_us for row in kept])
        return _answers(out)

    def _attempted(self, held: tuple | None, fresh: list[dict], passed_us: int) -> tuple[tuple | None, list]:
        """What to hold of a request after some attempts of it, and the answers with whether they are late."""
        names, out = [*_FIELDS, "final"], []
        best, attempts, last_us, decided = None, set(), 0, False
        if held is None:
            # Nothing of the request is held: what the watermark has passed may contradict
            # decisions that were made without it.
            out = [(r, True) for r in _chosen([r for r in fresh if r["finished_us"] < passed_us])]
            fresh = [r for r in fresh if r["finished_us"] >= passed_us]
            if not fresh:
                return None, out
        else:
            *values, known, last_us, decided = held[len(REQUEST_KEYS) :]
            attempts = {int(a) for a in known.split(",")}
            best = None if decided else dict(zip(names, values))
        attempts |= {r["attempt"] for r in fresh}
        last_us = max(last_us, *(r["finished_us"] for r in fresh))
        if not decided:
            (best,) = _chosen([*fresh, best] if best else fresh)
            complete = self.in_order or all(a in attempts for a in range(1, best["attempt"]))
            decided = best["final"] and complete
            if decided:
                out.append((best, False))
        values = [None] * len(names) if decided else [best[name] for name in names]
        return (*values, ",".join(map(str, sorted(attempts))), last_us, decided), out


def _requests(frame: pd.DataFrame) -> Iterator[tuple]:
    poll, *names = [frame[name].tolist() for name in REQUEST_KEYS]
    return zip([None if pd.isna(p) else int(p) for p in poll], *names)


def _tuples(frame: pd.DataFrame) -> Iterator[tuple]:
    columns = [frame[name].tolist() for name in [*_FIELDS, "final"]]
    for row in zip(*columns):
        attempt, status, started, finished, body, final = row
        yield int(attempt), None if pd.isna(status) else int(status), int(started), int(finished), body, bool(final)


def _chosen(rows: list[dict]) -> list[dict]:
    """The row that counts, of all rows of one request; none of none."""
    if not rows:
        return []
    least = min(rows, key=lambda r: (not r["final"], r["attempt"] if r["final"] else -r["attempt"], r["started_us"]))
    return [least if least["final"] else {**least, "body": None}]


def _answers(out: list[tuple[tuple, dict, bool]]) -> Iterator[pd.DataFrame]:
    if not out:
        return iter(())
    columns = dict(zip(REQUEST_KEYS, zip(*[request for request, _, _ in out])))
    for name in _FIELDS:
        columns[name] = [r[name] for _, r, _ in out]
    frame = pd.DataFrame({**{k: list(v) for k, v in columns.items()}, "late": [late for _, _, late in out]})
    return iter([frame[ANSWER_SCHEMA.fieldNames()].astype({"poll_id": "Int64", "status": "Int32"})])


def resolved_answers(
    responses: DataFrame, lateness: str, wait_seconds: int = WAIT_SECONDS, in_order: bool = True
) -> DataFrame:
    """One answer per request of a stream of responses, as soon as it is decided.

    The clock is the arrival. ``late`` marks answers of requests nothing was held of when
    the watermark had passed them: they come out at once, and nothing is dropped. Failed
    attempts carry no body. Attempts of one request come within ``wait_seconds`` of each
    other. Needs the RocksDB state store.
    """
    marked = responses.withWatermark("answered_ts", lateness) if "answered_ts" in responses.columns else (
        responses.withColumn("answered_ts", F.timestamp_micros("finished_us")).withWatermark("answered_ts", lateness)
    )
    # The processor sees late rows only if no watermarked column goes in.
    final = (response_class() != RETRYABLE).alias("final")
    keys = [F.coalesce(k, F.lit("")).alias(k) if k in ("query_id", "fe_host", "endpoint") else F.col(k) for k in REQUEST_KEYS]
    plain = marked.select(*keys, *_FIELDS, final).withColumn(BUCKET, bucket(*REQUEST_KEYS))
    return plain.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=_AttemptProcessor(wait_seconds * MICROS, in_order),
        outputStructType=ANSWER_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )
