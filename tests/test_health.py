import random

from profile_lake.operators import health
from profile_lake.schemas import MICROS


def polls(spark, rows):
    return spark.createDataFrame(rows, "fe_host string, poll_us long, event_id long, ok boolean")


def delays(spark, oks, step=60):
    rows = [("h", i * step * MICROS, i, ok) for i, ok in enumerate(oks)]
    got = health.backoff_schedule(polls(spark, rows)).orderBy("event_id").collect()
    return [r.delay_s for r in got]


def test_delays_double_reset_and_stop_growing(spark):
    oks = [False] * 3 + [True] + [False] * 8
    assert delays(spark, oks) == [10, 20, 40, None, 10, 20, 40, 80, 160, 300, 300, 300]


def test_twenty_failures_stay_at_the_cap(spark):
    assert delays(spark, [False] * 20)[-1] == 300


def model(rows):
    failures, out = {}, {}
    for host, at, number, ok in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        failures[host] = 0 if ok else failures.get(host, 0) + 1
        out[number] = failures[host]
    return out


def test_streaks_cross_buckets(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "a", "a", "b"]), rng.randrange(0, 5000), number, rng.random() < 0.15)
        for number in range(1500)
    ]
    for width in (7, 100, 100_000):
        got = health.backoff_schedule(polls(spark, rows), bucket_us=width)
        assert {r.event_id: r.failures for r in got.collect()} == model(rows)


def test_hosts_in_backoff_are_skipped(spark):
    rows = [("a", 0, 1, True), ("b", 5 * MICROS, 2, False), ("c", 0, 3, False), ("c", 1, 4, True)]
    state = health.host_state(health.backoff_schedule(polls(spark, rows)))
    hosts = spark.createDataFrame([(h,) for h in "abcd"], "fe_host string")

    def ready(now_s):
        got = health.pollable_hosts(hosts, state, int(now_s * MICROS))
        return sorted(r.fe_host for r in got.collect())

    assert ready(14.9) == ["a", "c", "d"]
    assert ready(15) == ["a", "b", "c", "d"]
