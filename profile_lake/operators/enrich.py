"""Profile lookup and the outcome of every listed row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profile_lake.operators.records import is_finished
from profile_lake.schemas import COLLECTED, DEDUP, FETCH_ERROR, UNFINISHED


def enrich(details: DataFrame, profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their profile text; rows without one are left out.

    Apply after deduplication, when ids hardly repeat, so that texts move once.
    """
    return details.join(profiles, list(keys))


def outcome(fetch_reason: Column, fetched: Column) -> Column:
    """Outcome of a row from ``is_first``, the fetch's skip reason and whether it was made."""
    return (
        F.when(~is_finished(), UNFINISHED)
        .when(~F.col("is_first"), DEDUP)
        .when(~fetched, FETCH_ERROR)
        .otherwise(F.coalesce(fetch_reason, F.lit(COLLECTED)))
    )


def classify(labelled: DataFrame, fetches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``outcome``. ``fetches`` has one row per key with a nullable ``skip_reason``.

    Only first rows carry a join key, so a hot id does not crowd one join task and the
    labels are made once.
    """
    made = fetches.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in fetches.columns if c not in keys])
    made = made.withColumn("_fetched", F.lit(True))
    same = reduce(Column.__and__, [F.when(F.col("is_first"), F.col(k)) == F.col(f"_{k}") for k in keys])
    return (
        labelled.join(made, same, "left")
        .withColumn("outcome", outcome(F.col("skip_reason"), F.coalesce("_fetched", F.lit(False))))
        .drop("skip_reason", "_fetched", *[f"_{k}" for k in keys])
    )
