"""Ordered computations over keys that may hold a large share of all rows.

A window ``partitionBy(key)`` puts every row of a key into one task. Here a key's
time line is cut into fixed-width buckets: rows are ordered only inside
``(key, bucket)``, and a small table with one row per key and bucket carries what
came before. The carry table's size depends on the time span, not on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def bucket_of(value: Column | str, width: int) -> Column:
    """Number of the half-open bucket of ``width`` that holds an integer value."""
    number = F.col(value) if isinstance(value, str) else value
    size = F.lit(width).cast("long")
    return ((number - F.pmod(number, size)) / size).cast("long")


def prefix_by_bucket(
    df: DataFrame, keys: Sequence[str], bucket: str, total: Column, name: str
) -> DataFrame:
    """Per key and bucket: the aggregate ``total`` summed over all earlier buckets."""
    before = (
        Window.partitionBy(*keys)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.groupBy(*keys, bucket)
        .agg(total.alias("_total"))
        .select(*keys, bucket, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias(name))
    )


def running_rank(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    name: str = "rank",
) -> DataFrame:
    """Add the 1-based position of each row inside its key, ordered by ``order``.

    ``bucket`` must rise with ``order``; its number of values per key bounds the carry.
    Rows and carry are both partitioned by (key, bucket), so adding the carry moves no
    row a second time.
    """
    cut = df.withColumn(BUCKET, bucket)
    carry = prefix_by_bucket(cut, keys, BUCKET, F.count(F.lit(1)), "_before")
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    ranked = cut.withColumn("_inside", F.row_number().over(inside))
    return (
        ranked.join(carry, [*keys, BUCKET])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop(BUCKET, "_inside", "_before")
    )
