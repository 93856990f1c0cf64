"""Cumulative histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def le_label(bound: float) -> str:
    return f"{bound:g}"


def le_histogram(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    bounds: Sequence[float],
    scale: int = 1,
) -> DataFrame:
    """Counts of values at or below each bound, per key, with total sum and count.

    ``value`` is an integer column in units of ``1/scale`` (microseconds: one million),
    so the sum is exact whatever the order of rows. One row per key and bound (``le``),
    plus ``+Inf``. All bounds are counted in one aggregation: a task sends one row per
    key, however many rows the key has.
    """
    counts = [
        F.count(F.when(value <= F.lit(round(bound * scale)), 1)).alias(f"_b{i}")
        for i, bound in enumerate(bounds)
    ]
    totals = df.groupBy(*keys).agg(
        *counts, F.count(value).alias("total_count"), F.sum(value).alias("_sum")
    )
    buckets = [
        F.struct(F.lit(le_label(b)).alias("le"), F.col(f"_b{i}").alias("n"))
        for i, b in enumerate(bounds)
    ] + [F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("n"))]
    return totals.select(
        *keys,
        F.explode(F.array(*buckets)).alias("_bucket"),
        (F.col("_sum") / F.lit(scale)).alias("sum_value"),
        "total_count",
    ).select(
        *keys, "_bucket.le", F.col("_bucket.n").alias("bucket_count"), "sum_value", "total_count"
    )
