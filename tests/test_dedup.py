import random

import pytest
from pyspark.sql import functions as F

from profile_lake.operators import dedup

SCHEMA = "query_id string, event_us long, fe_host string, event_id long"


def model(rows, ttl, seen=()):
    """The rule, one row at a time."""
    last, kept = dict(seen), []
    for query_id, at, _, number in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        if query_id not in last or at - last[query_id] > ttl:
            last[query_id] = at
            kept.append(number)
    return sorted(kept)


def crowded_rows(seed=5, n=3000):
    """A third and more of all rows share one id, with dense, sparse and repeated instants."""
    rng = random.Random(seed)
    spans = [(0, 4000), (0, 4000), (9000, 9500), (20_000, 20_300), (-900, 0)]
    return [
        (
            rng.choice(["hot", "hot", "hot", "b", f"c{rng.randrange(40)}"]),
            rng.randrange(*rng.choice(spans)),
            f"h{rng.randrange(3)}",
            number,
        )
        for number in range(n)
    ]


def numbers(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_suppressed_rows_do_not_extend_the_window(spark):
    rows = [("q", at, "h", at) for at in (0, 100, 1700, 1801, 1900, 3700)]
    kept = dedup.ttl_dedup(spark.createDataFrame(rows, SCHEMA), 1800)
    assert numbers(kept) == [0, 1801, 3700]


@pytest.mark.parametrize("ttl", [500, 37, 0])
def test_hot_ids_follow_the_same_rule(spark, ttl):
    rows = crowded_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    assert numbers(dedup.ttl_dedup(df, ttl)) == model(rows, ttl)


def test_a_long_chain_of_one_id(spark):
    # Each instant is 0.6 TTL after the one before: every second one is accepted.
    rows = [("hot", 600 * i, "h", i) for i in range(1500)] + [("b", 3, "h", 10_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert numbers(dedup.ttl_dedup(df, 1000)) == model(rows, 1000)


def test_links_lead_to_the_first_instant_beyond_the_ttl(spark):
    instants = [0, 1, 99, 100, 101, 102, 201, 350, 460, 461]
    df = spark.createDataFrame([("q", at) for at in instants], "query_id string, at long")
    got = {r.at: (r.starts, r.to) for r in dedup.linked_instants(df, 100).collect()}
    for i, at in enumerate(instants):
        after = [x for x in instants if x > at + 100]
        starts = i == 0 or at - instants[i - 1] > 100
        assert got[at][0] == starts
        # A missing link is one into a run's start.
        if got[at][1] is None:
            assert not after or after[0] - instants[instants.index(after[0]) - 1] > 100
        else:
            assert got[at][1] == after[0]


def test_earlier_state_is_continued(spark):
    rows = crowded_rows(seed=9, n=600)
    seen = {"hot": 150, "b": -4000, "c1": 25_000}
    df = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(list(seen.items()), "query_id string, first_seen_us long")
    assert numbers(dedup.ttl_dedup(df, 700, known)) == model(rows, 700, seen.items())


def test_labels_agree_with_the_dropping_form(spark):
    rows = crowded_rows(seed=2, n=400)
    df = spark.createDataFrame(rows, SCHEMA)
    labelled = dedup.label_first(df, 300)
    assert labelled.count() == len(rows)
    assert numbers(labelled.where("is_first")) == model(rows, 300)


def test_first_occurrence_and_seen_set(spark):
    rows = [("a", 5, "h2", 1), ("a", 5, "h1", 2), ("a", 9, "h1", 3), ("b", 1, "h1", 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert numbers(dedup.first_occurrence(df)) == [2, 4]
    seen = spark.createDataFrame([("a", 0)], "query_id string, first_seen_us long")
    assert numbers(dedup.drop_seen(df, seen)) == [4]
    merged = dedup.merge_seen(seen, dedup.first_occurrence(df)).collect()
    assert {r.query_id: r.first_seen_us for r in merged} == {"a": 5, "b": 1}


def test_first_occurrence_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 5, "h2", 1)], SCHEMA)
    plan = dedup.first_occurrence(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def seen_table(spark, ages):
    return spark.createDataFrame(list(ages), "query_id string, first_seen_us long")


def test_ttl_eviction_keeps_the_edge(spark):
    seen = seen_table(spark, [("old", 0), ("new", 100)])
    for now, left in ((150, 2), (200, 2), (250, 1), (301, 0)):
        assert dedup.compact_seen(seen, now, 200).count() == left


def test_live_entries_stay_however_many(spark):
    n = 150_000
    seen = spark.range(n).select(
        F.format_string("q%06d", "id").alias("query_id"), (F.col("id") % 50).alias("first_seen_us")
    )
    assert dedup.compact_seen(seen, 60, 1000).count() == n
    assert dedup.compact_seen(seen, 1020, 1000).count() == n * 3 // 5
