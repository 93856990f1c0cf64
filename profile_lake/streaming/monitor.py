"""Counters of running streams."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from profile_lake.functions.columns import micros_to_ntz
from profile_lake.schemas import COLLECTED
from profile_lake.session import scratch_path
from profile_lake.sources import tables
from profile_lake.streaming.landing import land_in_turns


def interval_counts(
    outcomes: DataFrame, time: str = "event_ts", width: str = "5 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """Collected and skipped rows per interval and host."""
    return (
        outcomes.withWatermark(time, lateness)
        .groupBy(F.window(time, width).alias("interval"), "fe_host")
        .agg(
            F.count(F.when(F.col("outcome") == COLLECTED, 1)).alias("collected"),
            F.count(F.when(F.col("outcome") != COLLECTED, 1)).alias("skipped"),
        )
    )


def poll_counts(
    polls: DataFrame, width: str = "5 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """Polls and failed polls per interval and host."""
    return (
        polls.withColumn("poll_ts", F.timestamp_micros("poll_us"))
        .withWatermark("poll_ts", lateness)
        .groupBy(F.window("poll_ts", width).alias("interval"), "fe_host")
        .agg(
            F.count(F.lit(1)).alias("polls"),
            F.count(F.when(~F.col("ok"), 1)).alias("failed"),
        )
    )


def observed(rows: DataFrame, name: str = "collect") -> DataFrame:
    """Rows with live counters, reported with each micro-batch under ``name``."""
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("query_id") == "", 1)).alias("without_id"),
    )


class LiveCounters(StreamingQueryListener):
    """Sums the counters of :func:`observed` and remembers the last progress reports."""

    def __init__(self, name: str = "collect", remember: int = 100) -> None:
        self.name = name
        self.totals: dict[str, int] = {}
        self.batches = 0
        self.recent: deque = deque(maxlen=remember)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.recent.append(event.progress.json)
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches += 1
            for key, value in row.asDict().items():
                self.totals[key] = self.totals.get(key, 0) + value

    def onQueryTerminated(self, event) -> None:
        pass


def latest_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run windowed counts in update mode to the end; per key the last micro-batch's row.

    The state forgets windows the watermark has passed. Each micro-batch adds the windows
    it changed to the table, under its number; a repeated one replaces its own.
    """
    spark = counts.sparkSession
    out = scratch_path(spark, "stream-out")
    (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "stream-state"))
        .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    written = spark.read.schema(f"{counts.schema.toDDL()}, batch long").parquet(out)
    rest = [c for c in counts.columns if c not in keys]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_newest"))
    return newest.select(*keys, "_newest.*")


def drain_poll_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the sample poll log through :func:`poll_counts`, a turn per micro-batch."""
    polls = tables.poll_attempts(spark, sf_dir)
    landed = scratch_path(spark, "landed")
    files = land_in_turns(polls, "poll_us", landed)
    stream = spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", files).parquet(landed)
    counts = poll_counts(stream).select(
        micros_to_ntz(F.unix_micros("interval.start")).cast("string").alias("window_start"),
        "fe_host",
        "polls",
        "failed",
    )
    return latest_counts(counts, ["window_start", "fe_host"])


def drain_interval_counts(outcomes: DataFrame) -> DataFrame:
    """Run (fe_host, event_us, outcome) through :func:`interval_counts`, a turn per micro-batch."""
    spark = outcomes.sparkSession
    landed = scratch_path(spark, "landed")
    files = land_in_turns(outcomes, "event_us", landed)
    stream = spark.readStream.schema(outcomes.schema).option("maxFilesPerTrigger", files).parquet(landed)
    counts = interval_counts(stream.withColumn("event_ts", F.timestamp_micros("event_us"))).select(
        micros_to_ntz(F.unix_micros("interval.start")).cast("string").alias("window_start"),
        "fe_host",
        "collected",
        "skipped",
    )
    return latest_counts(counts, ["window_start", "fe_host"])
