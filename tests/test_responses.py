from pyspark.sql import functions as F

from profile_lake.functions import cap_bytes
from profile_lake.sources import (
    classify_response,
    decode_listings,
    parse_hosts,
    poll_log,
    polls,
    profile_texts,
    read_responses,
    resolve_attempts,
    union_hosts,
)
from profile_lake.sources.responses import listings

from tests.helpers import listing, profile, responses


def test_classes(spark):
    rows = [listing(i, "h", "[]", status=s) for i, s in enumerate([200, 404, 403, 500, 503, None])]
    rows += [profile(i, "h", "q", status=s) for i, s in enumerate([200, 404, 302, 502])]
    got = classify_response(responses(spark, rows)).orderBy("endpoint", "poll_id").collect()
    # "profile" sorts before "query_detail"
    assert [r.response_class for r in got] == [
        "ok", "not_found", "error", "retryable",
        "ok", "error", "error", "retryable", "retryable", "retryable",
    ]


def test_retry_succeeds_on_second_attempt(spark):
    rows = [
        listing(1, "h", "[]", status=500, attempt=1), listing(1, "h", "[]", attempt=2),
        listing(2, "h", "[]", status=500, attempt=1), listing(2, "h", "[]", status=None, attempt=2),
        listing(3, "h", "[]", attempt=1), listing(3, "h", "[]", attempt=2),
        listing(4, "h", "[]", status=500, attempt=1), listing(4, "h", "[]", status=503, attempt=2),
        listing(4, "h", "[]", attempt=3),
    ]
    log = poll_log(responses(spark, rows))
    got = {r.poll_id: (r.attempt, r.status) for r in resolve_attempts(log).collect()}
    assert got == {1: (2, 200), 2: (2, None), 3: (1, 200), 4: (3, 200)}
    assert resolve_attempts(log, retries=1).where("poll_id = 4").first().status == 503


def test_attempts_are_limited_before_the_shuffle(spark):
    plan = resolve_attempts(poll_log(responses(spark, [listing(1, "h", "[]")])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_cap_replaces_half_a_character(spark):
    df = spark.sql("select cast('aé' as binary) b")
    assert df.select(cap_bytes("b", 2).alias("t")).first().t == "a�"
    assert df.select(cap_bytes("b", 3).alias("t")).first().t == "aé"


def test_profile_texts_mark_truncation(spark):
    rows = [profile(1, "h", "a", "x" * 10), profile(1, "h", "b", "y" * 11), profile(1, "h", "c", status=404)]
    got = {r.query_id: (len(r.profile_text), r.truncated) for r in profile_texts(responses(spark, rows), 10).collect()}
    assert got == {"a": (10, False), "b": (10, True)}
    whole = profile_texts(responses(spark, rows)).collect()
    assert {r.query_id: len(r.profile_text) for r in whole} == {"a": 10, "b": 11}


def test_polls_of_landed_responses(spark):
    rows = [
        listing(1, "a", "[]", at=1000), profile(1, "a", "q", "t", at=5000),
        listing(2, "a", "x", status=500, at=9000), listing(2, "a", "[]", attempt=2, at=9700),
        listing(3, "a", "not json", at=20_000), listing(4, "a", "no", status=403, at=30_000),
    ]
    landed = responses(spark, rows)
    got = polls(landed, decode_listings(listings(landed))).collect()
    assert {r.poll_id: (r.poll_us, r.ok, r.duration_us) for r in got} == {
        1: (1000, True, 4500), 2: (9000, True, 1200), 3: (20_000, False, 500), 4: (30_000, False, 500),
    }


def test_hosts(spark):
    df = spark.createDataFrame([(" fe-0:8030, ,fe-1:8030,,",)], "h string")
    assert df.select(parse_hosts("h")).first()[0] == ["fe-0:8030", "fe-1:8030"]


def test_read_back_and_union(spark, tmp_path):
    one = responses(spark, [listing(1, "a", "[]")])
    two = responses(spark, [listing(1, "b", "[]")])
    path = str(tmp_path / "landed")
    union_hosts(one, two).write.parquet(path)
    got = read_responses(spark, path)
    assert got.select(F.collect_set("fe_host")).first()[0].__len__() == 2
    assert "body" not in poll_log(got).columns
    union_hosts(one, two).write.json(path + "-json")
    assert bytes(read_responses(spark, path + "-json", "json").first().body) == b"[]"
