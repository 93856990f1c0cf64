"""The collection as one streaming query: every listed row with what became of it.

Responses pass two stateful operators. The first decides requests (:mod:`attempts`). Its
answers become one flow of rows: listed rows, fetch answers, and rows that need no state.
The second operator takes ids by bucket. It applies the TTL rule, brings accepted rows
and fetch answers together and returns every listed row once, tagged with its outcome;
unreadable bodies come out as dead letters. Nothing is dropped: rows of answers that come
after the watermark are tagged `late`.

Two ways to decide. With ``in_order`` responses land in clock order, a row is decided in
the micro-batch that brings it. Else a row is held until the watermark has passed it, so
that rows that come late, but within the lateness, change the choice as they do in batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from profile_lake.functions.columns import body_text, rfc3339_from_millis
from profile_lake.operators import progress as marks
from profile_lake.operators import records
from profile_lake.schemas import (
    COLLECTED,
    DEDUP,
    DEDUP_TTL_SECONDS,
    FETCH_ERROR,
    LISTING,
    MICROS,
    PROFILE,
    UNFINISHED,
)
from profile_lake.session import fixed_value, run_to_end, scratch_folder, stage
from profile_lake.sinks.commits import publish_batch
from profile_lake.sources.listing import decode_listings
from profile_lake.sources.responses import fetch_outcome
from profile_lake.streaming.attempts import WAIT_SECONDS, resolved_answers
from profile_lake.streaming.buckets import BUCKET, HeldRows, LastAccepted, bucket, set_timer
from profile_lake.streaming.dedup import use_rocksdb

#: Rows of an answer that came after the watermark, and dead letters.
LATE = "late"
UNREADABLE = "unreadable"

#: What tells rows of one id and arrival apart, as in batch.
_ORDER = ["finished_us", "event_time", "fe_host", "poll_id", "position"]
_REST = ["state", "database", "sql_text", "user", "start_time_ms", "end_time_ms", "latency"]
_ROW = [*_ORDER, *_REST]
_TYPES = {
    **{c: T.LongType() for c in ("finished_us", "event_time", "poll_id", "start_time_ms", "end_time_ms", "latency")},
    "position": T.IntegerType(),
}
_INT = {T.LongType(): "Int64", T.IntegerType(): "Int32"}


def _fields(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES.get(n, T.StringType())) for n in names])


TAGGED_SCHEMA = T.StructType(
    [
        *_fields(["outcome", "query_id", *_ROW, "profile_text", "endpoint"]),
        T.StructField("body", T.BinaryType()),
    ]
)


_WAITING = _fields(["query_id", *_ROW, "accepted"])
_FETCHES = _fields(["query_id", "poll_id", "fe_host", "reason", "profile_text", "finished_us"])


class _OutcomeProcessor(StatefulProcessor):
    """A bucket of ids: their undecided and open rows, fetch answers and last accepted instants.

    ``hold_us`` is how long an answer may have been held before it got here.
    """

    def __init__(self, ttl_us: int, fetch_us: int, hold_us: int, in_order: bool) -> None:
        self.ttl_us = ttl_us
        self.fetch_us = fetch_us
        self.hold_us = hold_us
        self.in_order = in_order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = LastAccepted(handle)
        self.waiting = HeldRows(handle, "waiting", _WAITING)
        self.fetches = HeldRows(handle, "fetches", _FETCHES)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        set_timer(self.handle, [self.last.begin(initialState) + self.ttl_us + self.hold_us])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        listed, answered = [], []
        for frame in rows:
            passing = frame[frame["kind"] == "pass"]
            if len(passing):
                yield _tagged(passing.assign(outcome=passing["reason"]))
            for r in _dicts(frame[frame["kind"] == "fetch"]):
                answered.append(tuple(r[c] for c in _FETCHES.fieldNames()))
            for r in _dicts(frame[frame["kind"] == "row"]):
                listed.append((r["query_id"], *[r[c] for c in _ROW], None))
        yield from self._settled(listed, answered, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled([], [], timerValues)

    def close(self) -> None:
        pass

    def _settled(self, listed: list[tuple], answered: list[tuple], timerValues) -> Iterator[pd.DataFrame]:
        """Decide what can be decided, return it, and set the next timer."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000 - self.hold_us
        last, before, answers = self.last.read(), self.waiting.read(), self.fetches.read()
        cut = len(_ORDER) + 1
        # One row per id and place and one answer per id and poll, the latest.
        waiting = {row[:cut]: row[cut:] for row in [*before, *listed]}
        fetches = {row[:3]: row[3:] for row in [*answers, *answered]}
        out, left, wake, used, refused = [], [], [], set(), set()
        for (query_id, *place), rest in sorted(waiting.items(), key=lambda row: row[0]):
            at, poll = place[0], (query_id, place[3], place[2])
            accepted = rest[-1] is not None
            if not accepted:
                if query_id in last and at - last[query_id] <= self.ttl_us:
                    out.append((query_id, place, rest, DEDUP, None))
                    refused.add(poll)
                    continue
                if not (self.in_order or at < passed):
                    left.append((query_id, *place, *rest))
                    wake.append(at + self.hold_us)
                    continue
                last[query_id] = at
            if poll in fetches:
                reason, text, _ = fetches[poll]
                out.append((query_id, place, rest, COLLECTED if reason is None else reason, text))
                used.add(poll)
            elif at + self.fetch_us < passed:
                out.append((query_id, place, rest, FETCH_ERROR, None))
            else:
                left.append((query_id, *place, *rest[:-1], "yes"))
                wake.append(at + self.fetch_us + self.hold_us)
        # A fetch answer that is taken, whose listing can no longer come, or whose poll listed only
        # rows that are not taken, is done with. The rows a poll lists of an id come together.
        refused.difference_update((row[0], row[4], row[3]) for row in left)
        open_answers = [
            (*poll, *answer)
            for poll, answer in fetches.items()
            if poll not in used and poll not in refused and answer[-1] + self.fetch_us >= passed
        ]
        wake += [answer[-1] + self.fetch_us + self.hold_us for answer in open_answers]
        last = {q: at for q, at in last.items() if at + self.ttl_us >= passed}
        wake += [at + self.ttl_us + self.hold_us for at in last.values()]
        self.last.write(last)
        self.waiting.write(left, before)
        self.fetches.write(open_answers, answers)
        set_timer(self.handle, wake)
        if out:
            columns = dict(zip(_ORDER, zip(*[o[1] for o in out])))
            columns.update(zip(_REST, zip(*[o[2][:-1] for o in out])))
            frame = pd.DataFrame({k: list(v) for k, v in columns.items()})
            yield _tagged(
                frame.assign(
                    outcome=[o[3] for o in out],
                    query_id=[o[0] for o in out],
                    profile_text=[o[4] for o in out],
                    endpoint=LISTING,
                    body=None,
                )
            )


def _dicts(frame: pd.DataFrame) -> Iterator[dict]:
    names = frame.columns.tolist()
    whole = {n for n in names if n in _TYPES}
    for row in zip(*[frame[n].tolist() for n in names]):
        yield {n: None if v is None or v != v else int(v) if n in whole else v for n, v in zip(names, row)}


def _tagged(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[TAGGED_SCHEMA.fieldNames()].reset_index(drop=True)
    return frame.astype({n: _INT[t] for n, t in _TYPES.items()})


def _flow(answers: DataFrame, progress: DataFrame | None) -> DataFrame:
    """Decided answers as rows for the second operator, with their bucket.

    ``kind`` is row, fetch or pass; ``reason`` a fetch's skip reason, or the outcome of a row
    that passes.
    """
    good = F.col("status") == 200
    listed = (F.col("endpoint") == LISTING) & good
    decoded = decode_listings(
        answers.withColumns(
            {
                "listing_body": F.when(listed, F.col("body")),
                "profile_text": F.when((F.col("endpoint") == PROFILE) & good, body_text("body", None)),
                "fetched": F.col("endpoint") == PROFILE,
                "listed": listed,
                "asked": F.col("query_id"),
                "skip_reason": fetch_outcome(),
            }
        ).drop("body", "query_id"),
        "listing_body",
    )
    if progress is not None:
        decoded = marks.with_progress(decoded, progress).where(
            F.col("position").isNull() | (F.col("event_time") > F.col("last_event_time"))
        )
    row = F.col("position").isNotNull()
    bad = F.col("listed") & F.col("unreadable")
    late = F.col("late")
    kind = (
        F.when(F.col("fetched"), "fetch")
        .when(row & records.is_finished() & ~late, "row")
        .when(row | bad, "pass")
    )
    reason = (
        F.when(F.col("fetched"), F.col("skip_reason"))
        .when(bad, UNREADABLE)
        .when(row & late, LATE)
        .when(row, UNFINISHED)
    )
    query_id = F.when(F.col("fetched"), F.col("asked")).otherwise(F.col("query_id"))
    flow = decoded.select(
        kind.alias("kind"),
        query_id.alias("query_id"),
        reason.alias("reason"),
        *_ROW,
        "profile_text",
        "endpoint",
        F.col("listing_body").alias("body"),
    ).where("kind IS NOT NULL")
    # Rows that pass are dealt by poll: unfinished ones have no id, or one that repeats.
    dealt = F.when(F.col("kind") == "pass", bucket("fe_host", "poll_id")).otherwise(bucket("query_id"))
    return flow.withColumn(BUCKET, dealt)


def tagged_outcomes(
    responses: DataFrame,
    ttl_us: int = DEDUP_TTL_SECONDS * MICROS,
    lateness: str = "10 minutes",
    fetch_seconds: int = 600,
    wait_seconds: int = WAIT_SECONDS,
    in_order: bool = True,
    progress: DataFrame | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Every listed row of a stream of responses with its ``outcome``, collected ones with
    their text, and responses with unreadable bodies as outcome `unreadable`.

    A row waits up to ``fetch_seconds`` for the answer to its fetch. ``progress`` holds the
    marks an earlier stream ended with: rows up to them are left out, as in batch. ``seen``
    (query_id, first_seen_us) becomes the initial state of a new checkpoint.
    """
    answers = resolved_answers(responses, lateness, wait_seconds, in_order)
    hold_us = 2 * wait_seconds * MICROS  # an answer waits that long after it, its attempts being a wait apart
    initial = None
    if seen is not None:
        initial = seen.select(bucket("query_id"), "query_id", "first_seen_us").groupBy(BUCKET)
    return (
        _flow(answers, progress)
        .groupBy(BUCKET)
        .transformWithStateInPandas(
            statefulProcessor=_OutcomeProcessor(ttl_us, fetch_seconds * MICROS, hold_us, in_order),
            outputStructType=TAGGED_SCHEMA,
            outputMode="Append",
            timeMode="EventTime",
            initialState=initial,
        )
    )


def collected_records(tagged: DataFrame, cluster: str, at_us: Column) -> DataFrame:
    """The records among tagged rows."""
    stamp = rfc3339_from_millis(F.floor(at_us / 1000))
    return records.to_record(tagged.where(F.col("outcome") == COLLECTED), cluster, stamp)


def listed_outcomes(tagged: DataFrame) -> DataFrame:
    """One row per listed row, without its text."""
    return tagged.where(F.col("outcome") != UNREADABLE).drop("profile_text", "endpoint", "body")


def dead_letters(tagged: DataFrame) -> DataFrame:
    """The responses whose body could not be read."""
    return tagged.where(F.col("outcome") == UNREADABLE).select("poll_id", "fe_host", "endpoint", "finished_us", "body")


class WriteTables:
    """``foreachBatch`` function that writes a micro-batch of tagged rows to its three tables.

    Records go to the table at ``location``; outcomes and dead letters to folders below
    ``base``, one per micro-batch. A repeated micro-batch replaces its own output and keeps
    the time of its first try. ``run`` tells the streams that share the tables apart.
    """

    def __init__(
        self,
        location: str,
        base: str,
        cluster: str,
        clock_us: Callable[[], int],
        run: str = "first",
        compression: str | None = None,
    ) -> None:
        self.location = location
        self.base = base
        self.cluster = cluster
        self.clock_us = clock_us
        self.run = run
        self.compression = compression

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{self.run}-{batch_id}"
        now_us = fixed_value(spark, f"{self.base}/_times/{name}", self.clock_us())
        with scratch_folder(spark):
            # Staged: each of the tables would run both stateful operators again.
            tagged = stage(batch, "tagged")
            for table, rows in (("outcomes", listed_outcomes(tagged)), ("bad", dead_letters(tagged))):
                rows.write.mode("overwrite").parquet(f"{self.base}/{table}/batch={name}")
            taken = collected_records(tagged, self.cluster, F.lit(now_us))
            publish_batch(taken, self.location, now_us, name, compression=self.compression)


def run_outcomes(
    responses: DataFrame,
    base: str,
    cluster: str,
    clock_us: Callable[[], int],
    run: str = "first",
    compression: str | None = None,
    **options,
) -> None:
    """Run :func:`tagged_outcomes` over all landed responses into the tables below ``base``.

    The records' table is ``base``/table, its files packed by ``compression`` if it is given,
    the checkpoint ``base``/checkpoint-``run``.
    """
    spark = responses.sparkSession
    use_rocksdb(spark)
    writer = WriteTables(f"{base}/table", base, cluster, clock_us, run, compression)
    stream = tagged_outcomes(responses, **options).writeStream.option("checkpointLocation", f"{base}/checkpoint-{run}")
    run_to_end(spark, stream.trigger(availableNow=True).foreachBatch(writer).start())


def read_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """All outcomes written so far."""
    schema = T.StructType([f for f in TAGGED_SCHEMA if f.name not in ("profile_text", "endpoint", "body")])
    return spark.read.schema(schema.add("batch", T.StringType())).parquet(f"{base}/outcomes").drop("batch")
