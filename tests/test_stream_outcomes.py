import pytest

from profile_lake.plans.collect import collect
from profile_lake.schemas import MICROS
from profile_lake.sources import read_profiles, stream_responses
from profile_lake.streaming.collect import flush_writer
from profile_lake.streaming.dedup import use_rocksdb
from profile_lake.streaming.marks import read_marks, read_seen, start_marks
from profile_lake.streaming.outcomes import (
    TAGGED_SCHEMA,
    WriteTables,
    dead_letters,
    listed_outcomes,
    read_outcomes,
    run_outcomes,
    tagged_outcomes,
)

from tests.helpers import ARRIVAL, empty_state, listed, listing, profile, responses
from tests.test_streaming import Landing

DAY = 86_400 * MICROS


def ids(df):
    return sorted((r.query_id, r.outcome) for r in df.collect())


def closing(after):
    return [listing(99, "z", [], at=ARRIVAL + after)]


@pytest.fixture
def landing(spark, tmp_path):
    use_rocksdb(spark)
    return Landing(tmp_path)


def test_the_first_final_answer_counts_as_in_batch(spark, landing, tmp_path):
    rows = [
        listing(1, "a", "no", status=403), profile(1, "a", "qa", "text"),
        listing(2, "a", [listed("qa", 1), listed("qb", 2), listed("qc", 3), listed("", 4)], at=ARRIVAL + MICROS),
        profile(2, "a", "qa", "gone", status=404, at=ARRIVAL + MICROS), profile(2, "a", "qb", "text", at=ARRIVAL + MICROS),
        profile(2, "a", "qc", "busy", status=500, at=ARRIVAL + MICROS), listing(3, "b", "{cut", at=ARRIVAL + MICROS),
    ]
    later = [
        listing(1, "a", [listed("qx", 1)], attempt=2, at=ARRIVAL + 2 * MICROS),
        profile(2, "a", "qa", "text", attempt=2, at=ARRIVAL + 2 * MICROS),
        profile(2, "a", "qc", "text", attempt=2, at=ARRIVAL + 3 * MICROS),
    ]
    for part in (rows, later):
        landing.put(responses(spark, part))
    base = str(tmp_path / "out")
    run_outcomes(stream_responses(spark, landing.path, max_files=1), base, "main", lambda: ARRIVAL)
    seen, marks = empty_state(spark)
    batch = collect(responses(spark, rows + later), seen, marks, "main", ARRIVAL)
    got = read_outcomes(spark, base)
    assert ids(got) == ids(batch.outcomes) == [("", "unfinished"), ("qa", "not_found"), ("qb", "collected"), ("qc", "collected")]
    columns = batch.records.columns
    order = lambda df: df.select(*columns).orderBy("sr_query_id").collect()
    assert order(read_profiles(spark, f"{base}/table")) == order(batch.records)
    bad = spark.read.parquet(f"{base}/bad").collect()
    assert [(r.poll_id, r.fe_host, bytes(r.body)) for r in bad] == [(3, "b", b"{cut")]
    # A micro-batch that runs again changes nothing.
    WriteTables(f"{base}/table", base, "main", lambda: ARRIVAL + DAY)(spark.createDataFrame([], TAGGED_SCHEMA), 1)
    assert read_profiles(spark, f"{base}/table").count() == 1


def test_rows_within_the_lateness_change_the_choice_and_later_ones_are_tagged(spark, landing, tmp_path):
    minute = 60 * MICROS

    def poll(number, at_minute, query_id):
        at = ARRIVAL + at_minute * minute
        return [listing(number, "a", [listed(query_id, number)], at=at), profile(number, "a", query_id, f"text {number}", at=at)]

    # The earlier listing of q1 lands after the later one, its failed attempt after its answer.
    landing.put(responses(spark, poll(2, 20, "q1") + poll(4, 3, "q2")))
    landing.put(responses(spark, poll(1, 5, "q1") + [listing(5, "a", [listed("q5", 5)], attempt=2, at=ARRIVAL + 6 * minute)]))
    landing.put(responses(spark, [listing(5, "a", "", status=500, at=ARRIVAL + 6 * minute - 1000)]))
    landing.put(responses(spark, closing(2 * DAY)))
    landing.put(responses(spark, poll(7, 7, "q7") + closing(4 * DAY)))
    stream = tagged_outcomes(stream_responses(spark, landing.path, max_files=1), lateness="1 hour", in_order=False)
    out = str(tmp_path / "out")
    flush_writer(stream, str(tmp_path / "state"), None).format("parquet").option("path", out).start().awaitTermination()
    tagged = spark.read.schema(stream.schema).parquet(out)
    got = sorted((r.query_id, r.poll_id, r.outcome, r.profile_text) for r in tagged.collect())
    assert got == [
        ("q1", 1, "collected", "text 1"), ("q1", 2, "dedup", None), ("q2", 4, "collected", "text 4"),
        ("q5", 5, "fetch_error", None), ("q7", 7, "late", None),
    ]
    assert listed_outcomes(tagged).count() == 5 and dead_letters(tagged).count() == 0


def test_a_new_checkpoint_goes_on_from_marks_and_accepted_ids(spark, tmp_path):
    use_rocksdb(spark)
    found, seen = empty_state(spark)[1], None
    runs = [
        [listing(1, "a", [listed("q1", 10), listed("q2", 20)]), profile(1, "a", "q1", "t"), profile(1, "a", "q2", "t")],
        [listing(2, "a", [listed("q0", 15), listed("q1", 30), listed("q3", 40)], at=ARRIVAL + MICROS),
         profile(2, "a", "q3", "gone", status=404, at=ARRIVAL + MICROS)],
    ]
    outcomes = []
    for number, rows in enumerate(runs):
        base = str(tmp_path / str(number))
        responses(spark, rows).write.parquet(f"{base}/in")
        run_outcomes(stream_responses(spark, f"{base}/in"), base, "main", lambda: ARRIVAL, progress=found, seen=seen)
        for _ in range(2):  # the second time there is nothing new
            start_marks(spark, f"{base}/outcomes", f"{base}/marks").awaitTermination()
        found = read_marks(spark, f"{base}/marks", found)
        seen = read_seen(spark, f"{base}/checkpoint-first")
        outcomes.append(ids(read_outcomes(spark, base)))
    assert outcomes == [[("q1", "collected"), ("q2", "collected")], [("q1", "dedup"), ("q3", "not_found")]]
    assert [tuple(r) for r in found.collect()] == [("a", 30)]
    assert {r.query_id: r.first_seen_us for r in seen.collect()} == {
        "q1": ARRIVAL + 500, "q2": ARRIVAL + 500, "q3": ARRIVAL + MICROS + 500
    }
