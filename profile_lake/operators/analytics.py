"""Analyses over the collected table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profile_lake.functions.columns import fingerprint, period_start, period_text
from profile_lake.functions.ordered import bucket_of, running_rank
from profile_lake.session import stage

DIMENSIONS = ("cluster", "database", "user", "query_hash")
PERCENTILES = ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))


def duration_trend(
    profiles: DataFrame, grain: str = "hour", dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Runs, mean, exact percentiles and maximum of duration per period and dimension.

    Rows first shrink to one count per group and distinct duration, combined before the
    shuffle. Durations are whole milliseconds, so a group's task sorts its distinct
    durations, however many runs share them. Percentiles interpolate linearly.
    Rows without a start are left out.
    """
    keys = ["period", *dimensions]
    counts = (
        profiles.where(F.col("start_time") != "")
        .withColumn("period", period_text("start_time", grain))
        .groupBy(*keys, "duration_ms")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = Window.partitionBy(*keys)
    placed = counts.withColumns(
        {"upto": F.sum("n").over(group.orderBy("duration_ms")), "total": F.sum("n").over(group)}
    )
    bounds: list[Column] = []
    for p, name in PERCENTILES:
        place = (F.col("total") - 1) * F.lit(p)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            bounds.append(
                F.min(F.when(F.col("upto") > rank, F.col("duration_ms"))).alias(f"{side}_{name}")
            )
    grouped = placed.groupBy(*keys).agg(
        F.sum("n").alias("runs"),
        F.sum(F.col("n") * F.col("duration_ms")).alias("total_ms"),
        F.max("duration_ms").alias("max_ms"),
        *bounds,
    )
    quantiles = []
    for p, name in PERCENTILES:
        place = (F.col("runs") - 1) * F.lit(p)
        lo, hi = F.col(f"lo_{name}"), F.col(f"hi_{name}")
        quantiles.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return grouped.withColumn("period", period_start("period", grain)).select(
        *keys, "runs", (F.col("total_ms") / F.col("runs")).alias("avg_ms"), *quantiles, "max_ms"
    )


def duration_trend_approx(
    profiles: DataFrame,
    grain: str = "hour",
    dimensions: Sequence[str] = DIMENSIONS,
    accuracy: int = 10_000,
) -> DataFrame:
    """As :func:`duration_trend` with sketched percentiles: one shuffle of small sketches."""
    keys = ["period", *dimensions]
    return (
        profiles.where(F.col("start_time") != "")
        .withColumn("period", period_text("start_time", grain))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.avg("duration_ms").alias("avg_ms"),
            *[
                F.percentile_approx("duration_ms", p, accuracy).alias(name)
                for p, name in PERCENTILES
            ],
            F.max("duration_ms").alias("max_ms"),
        )
        .withColumn("period", period_start("period", grain))
    )


def statement_summary(profiles: DataFrame) -> DataFrame:
    """Per fingerprint: runs, users, first and last start, time spent and its share.

    The summary is staged, so the table is read once for both sums and total.
    """
    summary = stage(
        profiles.where(F.col("query_hash").isNotNull())
        .groupBy("query_hash")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.countDistinct("user").alias("users"),
            F.min("start_time").alias("first_seen"),
            F.max("start_time").alias("last_seen"),
            F.sum("duration_ms").alias("total_ms"),
        ),
        "statements",
    )
    total = summary.agg(F.sum("total_ms")).scalar()
    return summary.withColumn("share", F.when(total > 0, F.col("total_ms") / total))


def top_slow(profiles: DataFrame, k: int) -> DataFrame:
    """The k slowest runs: each task keeps k rows, and those are merged.

    Rank narrow rows, and join texts to the winners: see :func:`with_texts`.
    """
    return profiles.orderBy(F.desc("duration_ms"), "sr_query_id", "fe_host", "start_time").limit(k)


def with_texts(best: DataFrame, texts: DataFrame, key: str = "sr_query_id") -> DataFrame:
    """Few rows with the texts of their ids; the rows are broadcast, so texts do not move."""
    return texts.join(F.broadcast(best), key)


def top_slow_by(profiles: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The k slowest runs per key. Spark keeps k rows per key and task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(
        F.desc("duration_ms"), "sr_query_id", "fe_host", "start_time"
    )
    return profiles.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def duration_regression(
    profiles: DataFrame,
    trailing: int = 10,
    block_rows: int = 100_000,
) -> DataFrame:
    """Each run against the mean of the ``trailing`` runs before it of the same statement.

    A statement may own a large share of all runs. Runs are numbered minute by minute,
    cut into blocks of ``block_rows``, and each block gets copies of the ``trailing`` rows
    before it, so that a task sees at most one block.
    """
    # RFC 3339 texts sort by time.
    # Rows equal in all of these are interchangeable, so the order is total.
    order = ["start_time", "sr_query_id", "fe_host", "duration_ms"]
    runs = profiles.where(F.col("query_hash").isNotNull()).select("query_hash", *order)
    # Two branches read the runs: a narrow copy saves the second pass over the table.
    runs = stage(runs, "runs")
    ranked = running_rank(runs, ["query_hash"], period_text("start_time", "minute"), order)
    block_rows = max(block_rows, trailing)
    own = bucket_of(F.col("rank") - 1, block_rows)
    at_end = F.pmod(F.col("rank") - 1, F.lit(block_rows)) >= block_rows - trailing
    copies = F.when(at_end, F.array(own, own + 1)).otherwise(F.array(own))
    spread = ranked.select("*", own.alias("own_block"), F.explode(copies).alias("block"))
    in_block = Window.partitionBy("query_hash", "block").orderBy("rank")
    before = in_block.rowsBetween(-trailing, -1)
    return (
        spread.withColumns(
            {
                "previous_ms": F.lag("duration_ms").over(in_block),
                "trailing_sum": F.sum("duration_ms").over(before),
                "trailing_runs": F.count("duration_ms").over(before),
            }
        )
        .where(F.col("block") == F.col("own_block"))
        .select(
            "query_hash",
            *order,
            "rank",
            "previous_ms",
            F.when(
                F.col("trailing_runs") > 0, F.col("trailing_sum") / F.col("trailing_runs")
            ).alias("trailing_avg_ms"),
        )
        .withColumn(
            "ratio",
            F.when(
                F.col("trailing_avg_ms") > 0, F.col("duration_ms") / F.col("trailing_avg_ms")
            ),
        )
    )


def correlate(
    profiles: DataFrame, other: DataFrame, other_sql: str, other_count: str | None = None
) -> DataFrame:
    """Runs with what another system's log says about the same statement.

    The other log shrinks to one row per fingerprint first, so a statement frequent in
    both logs does not multiply. Rows without a fingerprint never match.
    """
    weight = F.lit(1) if other_count is None else F.col(other_count)
    known = (
        other.select(fingerprint(other_sql).alias("query_hash"), weight.alias("_n"))
        .where(F.col("query_hash").isNotNull())
        .groupBy("query_hash")
        .agg(F.count(F.lit(1)).alias("other_rows"), F.sum("_n").alias("other_runs"))
    )
    return profiles.join(known, "query_hash")


def correlate_statements(
    profiles: DataFrame, other: DataFrame, other_sql: str, other_count: str | None = None
) -> DataFrame:
    """One row per statement known to both systems; both sides shrink before the join."""
    ours = (
        profiles.where(F.col("query_hash").isNotNull())
        .groupBy("query_hash")
        .agg(F.count(F.lit(1)).alias("runs"), F.sum("duration_ms").alias("total_ms"))
    )
    return correlate(ours, other, other_sql, other_count)
