"""The batch pipeline: landed responses in, records and new state out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profile_lake.functions.columns import rfc3339_from_millis
from profile_lake.operators import dedup, enrich, progress as marks, records
from profile_lake.schemas import (
    COLLECTED,
    DEDUP_TTL_SECONDS,
    LISTING,
    MICROS,
    PROFILE,
)
from profile_lake.session import stage
from profile_lake.sources.listing import decode_listings, readable_rows, unreadable_responses
from profile_lake.sources.responses import (
    fetch_outcome,
    listings,
    poll_log,
    polls,
    profile_texts,
    resolve_attempts,
)

# Rows of one id and arrival are told apart by event time, host, poll and place.
TIES = ("event_time", "fe_host", "poll_id", "position")
REQUEST = ["poll_id", "fe_host"]
FETCH = ["poll_id", "fe_host", "query_id"]


@dataclass(frozen=True)
class Collected:
    """Result of one run. ``outcomes`` has one row per listed row, ``accepted`` the ids that passed
    the TTL rule with their time. ``seen`` is the new set, if the whole old one was given."""

    records: DataFrame
    outcomes: DataFrame
    progress: DataFrame
    seen: DataFrame
    accepted: DataFrame
    bad: DataFrame
    polls: DataFrame


def collect_profiles(
    details: DataFrame,
    profiles: DataFrame,
    cluster: str,
    collected_at: Column,
    ttl_us: int = DEDUP_TTL_SECONDS * MICROS,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Records of listed rows against a lookup of profile text by query id."""
    fresh = dedup.ttl_dedup(records.finished(details), ttl_us, seen)
    return records.to_record(enrich.enrich(fresh, profiles, ["query_id"]), cluster, collected_at)


def collect(
    responses: DataFrame,
    seen: DataFrame | Callable[[DataFrame], DataFrame],
    progress: DataFrame,
    cluster: str,
    now_us: int,
    ttl_us: int = DEDUP_TTL_SECONDS * MICROS,
) -> Collected:
    """One run over a set of landed responses.

    Bodies are decoded once, the deciding answers' and no others. Parsed rows and their outcomes are staged in the shared folder: each is made once
    and read by several results. Profile texts are read and joined only for records.

    ``seen`` is the seen set, or a function from a table of ids to their entries in it.
    """
    resolved = resolve_attempts(poll_log(responses))
    answered = resolved.where((F.col("endpoint") == LISTING) & (F.col("status") == 200))
    deciding = answered.select(*REQUEST, "attempt")
    listing = listings(responses).drop("query_id").join(deciding, [*REQUEST, "attempt"], "left_semi")
    decoded = stage(decode_listings(listing), "decoded")
    parsed = readable_rows(decoded).drop("endpoint", "status", "started_us", "attempt")
    details = stage(marks.newer_than_progress(parsed, progress), "details")

    finished = records.finished(details)
    if callable(seen):
        seen = seen(finished.select("query_id"))

    done = dedup.label_first(finished, ttl_us, seen, "finished_us", TIES)
    rest = details.where(~records.is_finished()).withColumn("is_first", F.lit(False))
    fetches = resolved.where(F.col("endpoint") == PROFILE).select(
        *FETCH, F.col("attempt").alias("fetch_attempt"), fetch_outcome().alias("skip_reason")
    )
    outcomes = stage(enrich.classify(done.unionByName(rest), fetches, FETCH), "outcomes")

    texts = profile_texts(responses).select(
        *FETCH, F.col("attempt").alias("fetch_attempt"), "profile_text"
    )
    taken = outcomes.where(F.col("outcome") == COLLECTED)
    entries = enrich.enrich(taken, texts, [*FETCH, "fetch_attempt"])
    collected_at = rfc3339_from_millis(F.lit(now_us // 1000))

    accepted = outcomes.where("is_first").select("query_id", F.col("finished_us").alias("first_seen_us"))
    known = dedup.merge_seen(seen, accepted, "first_seen_us")
    return Collected(
        records=records.to_record(entries, cluster, collected_at),
        outcomes=outcomes,
        progress=marks.advance(progress, outcomes),
        seen=dedup.compact_seen(known, now_us, ttl_us),
        accepted=accepted,
        bad=unreadable_responses(decoded, listing.columns),
        polls=polls(responses, decoded),
    )
