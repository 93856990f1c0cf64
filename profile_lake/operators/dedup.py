"""Removing repeats of a query id.

The rule: an id is accepted, then suppressed until *more than* the TTL has passed since
the accepted row. Suppressed rows do not extend the window. The clock is any LONG column
in microseconds: arrival (``finished_us`` of the response) or the event time.

One algorithm serves every size, and no step gathers an id:

* rows shrink to distinct (id, instant) pairs;
* time is cut into cells as wide as the TTL. Inside (id, cell) each instant finds the
  instant before it and the first one more than a TTL later, its successor; the cells
  beside it lend their nearest instants;
* an instant more than a TTL after the one before it starts a run and is accepted. The
  others accepted are those that successors lead to from there. Links are doubled, so a
  chain of n acceptances takes log2(n) rounds, each a join on (id, instant).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profile_lake.functions.ordered import bucket_of
from profile_lake.session import stage

TIES = ("fe_host", "event_id")


def first_occurrence(
    details: DataFrame, clock: str = "event_us", ties: Sequence[str] = TIES
) -> DataFrame:
    """The first row of each id. Spark keeps one row per id and task before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(clock, *ties)
    return _first_by(details, order)


def _first_by(df: DataFrame, order: Window) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") == 1).drop("_nth")


def drop_seen(details: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose id is not in ``seen``. Use it when every entry is still inside its TTL."""
    return details.join(seen, "query_id", "left_anti")


def _open_rows(
    rows: DataFrame, seen: DataFrame, ttl_us: int, on: Sequence[str] = ("query_id",)
) -> DataFrame:
    """Rows no earlier acceptance (``last``) suppresses: an id starts afresh with them."""
    return (
        rows.join(seen, list(on), "left")
        .where(F.col("last").isNull() | (F.col("at") - F.col("last") > ttl_us))
        .select(*rows.columns)
    )


def linked_instants(instants: DataFrame, ttl_us: int) -> DataFrame:
    """Of distinct (query_id, at): ``starts`` a run, and the successor ``to`` (null for none).

    A successor that is two cells away or more and no cell's first is not needed: the
    instant it follows is more than a TTL before it, so it starts a run.
    """
    width = max(ttl_us, 1)
    celled = instants.select("query_id", "at", bucket_of("at", width).alias("cell"))
    edges = celled.groupBy("query_id", "cell").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    # What a cell's window sees: its instants, the nearest ones beside it, and a question
    # per instant of the cell one TTL earlier.
    own, beside, asked = 0, 1, 2
    entry = lambda cell, time, kind, of: F.struct(
        cell.alias("cell"), time.alias("time"), F.lit(kind).alias("kind"), of.alias("at")
    )
    nothing = F.lit(None).cast("long")
    cell, at = F.col("cell"), F.col("at")
    rows = celled.select(
        "query_id",
        F.explode(F.array(entry(cell, at, own, at), entry(bucket_of(at + ttl_us, width), at + ttl_us, asked, at))).alias("e"),
    ).unionByName(
        edges.select(
            "query_id",
            F.explode(
                F.array(entry(cell - 1, F.col("lo"), beside, nothing), entry(cell + 1, F.col("hi"), beside, nothing))
            ).alias("e"),
        )
    )
    group = Window.partitionBy("query_id", "cell")
    instant = F.when(F.col("kind") != asked, F.col("time"))
    # At one time a question comes before the instants when looking down from above.
    down = group.orderBy(F.desc("time"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    up = group.orderBy("time", "kind").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.select("query_id", "e.*").withColumns(
        {"above": F.last(instant, ignorenulls=True).over(down), "below": F.last(instant, ignorenulls=True).over(up)}
    )
    # Each instant's own entry knows the one before it, its question the one after.
    answered = seen.where(F.col("kind") != beside).groupBy("query_id", "at").agg(
        F.max(F.when(F.col("kind") == own, F.col("below"))).alias("before"),
        F.max(F.when(F.col("kind") == asked, F.when(F.col("above") > F.col("at") + ttl_us, F.col("above")))).alias("to"),
    )
    starts = F.col("before").isNull() | (F.col("at") - F.col("before") > ttl_us)
    return answered.select("query_id", "at", starts.alias("starts"), "to")


def accepted_instants(
    instants: DataFrame, ttl_us: int, seen: DataFrame | None = None
) -> DataFrame:
    """Of distinct (query_id, at) pairs those the TTL rule accepts."""
    if seen is not None:
        instants = _open_rows(instants, seen, ttl_us)
    linked = stage(linked_instants(instants, ttl_us), "ttl-links")
    taken = linked.where("starts").select("query_id", "at")
    # Links into a run's start add nothing.
    links = linked.join(
        taken.withColumnRenamed("at", "to"), ["query_id", "to"], "left_anti"
    ).where("to IS NOT NULL").select("query_id", "at", "to")
    reached = _followed(taken, links)
    if reached.isEmpty():
        return taken
    links, parts = stage(links, "ttl-links"), [taken]
    while True:
        reached = stage(reached, "ttl-reached")
        if reached.isEmpty():
            break
        parts.append(reached)
        links = stage(_doubled(links), "ttl-links")
        reached = _followed(_all(parts), links)
    return _all(parts)


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _followed(taken: DataFrame, links: DataFrame) -> DataFrame:
    """Where the links of accepted instants lead: a run is one chain, so each place once."""
    return taken.join(links, ["query_id", "at"]).select("query_id", F.col("to").alias("at"))


def _doubled(links: DataFrame) -> DataFrame:
    """Two links in a row as one."""
    later = links.select("query_id", F.col("at").alias("to"), F.col("to").alias("_further"))
    return links.join(later, ["query_id", "to"]).select("query_id", "at", F.col("_further").alias("to"))


def ttl_winners(rows: DataFrame, ttl_us: int, seen: DataFrame | None = None) -> DataFrame:
    """The accepted rows of (query_id, at, ties…); ties at one instant go to the least."""
    last = None if seen is None else seen.select("query_id", F.col("first_seen_us").alias("last"))
    # The least row of an instant: one row per instant and task before the shuffle.
    order = Window.partitionBy("query_id", "at").orderBy(*rows.columns[2:])
    least = stage(_first_by(rows, order), "ttl-instants")
    accepted = accepted_instants(least.select("query_id", "at"), ttl_us, last)
    return least.join(accepted, ["query_id", "at"], "left_semi")


def ttl_dedup(
    details: DataFrame,
    ttl_us: int,
    seen: DataFrame | None = None,
    clock: str = "event_us",
    ties: Sequence[str] = TIES,
) -> DataFrame:
    """The accepted rows of ``details``.

    ``seen`` (query_id, first_seen_us) carries acceptances of earlier runs. ``ties`` must
    tell rows of one id and instant apart.
    """
    rows = details.select("query_id", F.col(clock).alias("at"), *ties)
    winners = ttl_winners(rows, ttl_us, seen).withColumnRenamed("at", clock)
    return details.join(winners, ["query_id", clock, *ties], "left_semi")


def label_first(
    details: DataFrame,
    ttl_us: int,
    seen: DataFrame | None = None,
    clock: str = "event_us",
    ties: Sequence[str] = TIES,
) -> DataFrame:
    """All rows, with ``is_first`` true where :func:`ttl_dedup` would keep the row."""
    rows = details.select("query_id", F.col(clock).alias("at"), *ties)
    winners = ttl_winners(rows, ttl_us, seen).withColumnRenamed("at", clock)
    return (
        details.join(
            winners.withColumn("_first", F.lit(True)), ["query_id", clock, *ties], "left"
        )
        .withColumn("is_first", F.coalesce("_first", F.lit(False)))
        .drop("_first")
    )


def merge_seen(seen: DataFrame, accepted: DataFrame, clock: str = "event_us") -> DataFrame:
    """Known ids with the newly accepted ones; the latest acceptance of an id counts.

    An id accepted again after its TTL starts a new window, so the later time stands.
    """
    added = accepted.select("query_id", F.col(clock).alias("first_seen_us"))
    return (
        seen.select("query_id", "first_seen_us")
        .unionByName(added)
        .groupBy("query_id")
        .agg(F.max("first_seen_us").alias("first_seen_us"))
    )


def compact_seen(seen: DataFrame, now_us: int, ttl_us: int) -> DataFrame:
    """Entries still inside their TTL. Only expiry bounds the set: dropping live entries
    would let their ids in again."""
    return seen.where(F.col("first_seen_us") >= now_us - ttl_us)
