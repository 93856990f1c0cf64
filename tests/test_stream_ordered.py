from profile_lake.operators import dedup
from profile_lake.streaming.dedup import use_rocksdb
from profile_lake.streaming.ordered import ordered_ttl

from tests.test_streaming import MINUTE, ROWS, START, Landing, at, put_rows, run


def test_rows_out_of_order_and_an_initial_state(spark, tmp_path):
    use_rocksdb(spark)
    landing = Landing(tmp_path)
    batches = [
        [at(40, 1), at(5, 2, "b"), at(70, 3), at(12, 20, "s")],
        [at(0, 4), at(75, 5), at(40, 6), at(31, 7, "b")],
        [at(35, 8), at(36, 9, "b"), at(20, 10, "s"), at(45, 11, "s")],
    ]
    for rows in batches:
        put_rows(spark, landing, rows)
    for days in (1, 2):
        put_rows(spark, landing, [at(days * 1440, -days, "end")])
    seen = spark.createDataFrame([("s", START)], "query_id string, first_seen_us long")
    out = str(tmp_path / "out")
    stream = ordered_ttl(landing.stream(spark, ROWS), 30 * MINUTE, lateness="2 hours", seen=seen)
    run(stream, out, str(tmp_path / "state"))
    everything = spark.createDataFrame([r for rows in batches for r in rows], ROWS)
    want = sorted(r.event_id for r in dedup.ttl_dedup(everything, 30 * MINUTE, seen).collect())
    got = sorted(r.event_id for r in spark.read.parquet(out).where("event_id > 0").collect())
    assert got == want == [2, 3, 4, 8, 9, 11]
