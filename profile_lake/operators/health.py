"""Back-off of failing hosts, derived from the log of polls.

polls: (fe_host, poll_us, ok) plus any columns that order polls of one instant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profile_lake.functions.ordered import BUCKET, bucket_of
from profile_lake.schemas import (
    BACKOFF_FACTOR,
    BACKOFF_FIRST_SECONDS,
    BACKOFF_MAX_SECONDS,
    MICROS,
)

BUCKET_US = 3600 * MICROS


def backoff_schedule(
    polls: DataFrame, ties: Sequence[str] = ("event_id",), bucket_us: int = BUCKET_US
) -> DataFrame:
    """Add ``failures`` (consecutive, 0 after a success), ``delay_s`` and ``next_retry_us``.

    A few hosts own all polls, so a window per host would use a few tasks. Rows are
    ordered inside (host, hour); one summary row per host and hour carries the failures
    still open at its end into the next.
    """
    cut = polls.withColumn(BUCKET, bucket_of("poll_us", bucket_us))
    inside = Window.partitionBy("fe_host", BUCKET).orderBy("poll_us", *ties)
    # Successes so far number the failure streaks of the hour; streak 0 is still open
    # towards the hour before.
    streaks = cut.withColumn("_streak", F.sum(F.col("ok").cast("long")).over(inside))
    in_streak = Window.partitionBy("fe_host", BUCKET, "_streak").orderBy("poll_us", *ties)
    counted = streaks.withColumn(
        "_local",
        F.sum((~F.col("ok")).cast("long")).over(
            in_streak.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )

    per_streak = streaks.groupBy("fe_host", BUCKET, "_streak").agg(
        F.count(F.when(~F.col("ok"), 1)).alias("n")
    )
    hours = per_streak.groupBy("fe_host", BUCKET).agg(
        F.max("_streak").alias("oks"),
        F.max_by("n", "_streak").alias("open"),
    )
    by_hour = Window.partitionBy("fe_host").orderBy(BUCKET)
    runs = hours.withColumn("run", F.sum((F.col("oks") > 0).cast("long")).over(by_hour))
    in_run = (
        Window.partitionBy("fe_host", "run")
        .orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = runs.withColumn("open_after", F.sum("open").over(in_run)).select(
        "fe_host", BUCKET, F.coalesce(F.lag("open_after").over(by_hour), F.lit(0)).alias("_before")
    )

    failures = F.col("_local") + F.when(F.col("_streak") == 0, F.col("_before")).otherwise(0)
    # 30 doublings are far beyond the longest delay and stay inside a long.
    doubled = F.pow(F.lit(BACKOFF_FACTOR), F.least(F.col("failures"), F.lit(30)) - 1)
    delay = F.least(F.lit(BACKOFF_MAX_SECONDS), F.lit(BACKOFF_FIRST_SECONDS) * doubled)
    return (
        counted.join(carried, ["fe_host", BUCKET])
        .withColumn("failures", F.when(F.col("ok"), F.lit(0).cast("long")).otherwise(failures))
        .withColumn("delay_s", F.when(F.col("failures") > 0, delay.cast("long")))
        .withColumn("next_retry_us", F.col("poll_us") + F.col("delay_s") * MICROS)
        .drop(BUCKET, "_streak", "_local", "_before")
    )


def host_state(schedule: DataFrame, ties: Sequence[str] = ("event_id",)) -> DataFrame:
    """Each host's state after its last poll: (fe_host, failures, next_retry_us)."""
    latest = Window.partitionBy("fe_host").orderBy(
        F.desc("poll_us"), *[F.desc(tie) for tie in ties]
    )
    return (
        schedule.withColumn("_nth", F.row_number().over(latest))
        .where(F.col("_nth") == 1)
        .select("fe_host", "failures", "next_retry_us")
    )


def pollable_hosts(hosts: DataFrame, state: DataFrame, now_us: int) -> DataFrame:
    """Hosts not inside a back-off window; a window ending now is over."""
    waiting = state.where(F.col("next_retry_us") > now_us)
    return hosts.join(waiting, "fe_host", "left_anti")
