"""What a stream leaves on disk while it runs."""

from types import SimpleNamespace

from profile_lake import session
from profile_lake.streaming.landing import land_in_turns
from profile_lake.streaming.outcomes import _OutcomeProcessor


class _Listed:
    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.states = {}

    def getListState(self, name, schema):
        return self.states.setdefault(name, _Listed())

    def listTimers(self):
        return []

    def registerTimer(self, at):
        pass


def _row(query_id, at, poll):
    # query_id, the order (arrival, event time, host, poll, place), the rest, accepted
    return (query_id, at, at, "h", poll, 0, "FINISHED", "db", "", "u", 0, 0, 0, None)


def _answer(query_id, at, poll):
    return (query_id, poll, "h", None, f"text of {query_id} by {poll}", at)


def _settled(in_order, listed, answered, passed_us=0, handle=None):
    handle = handle or _Handle()
    processor = _OutcomeProcessor(ttl_us=1000, fetch_us=600, hold_us=0, in_order=in_order)
    processor.init(handle)
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: passed_us // 1000)
    out = [r for frame in processor._settled(listed, answered, now) for r in frame.itertuples()]
    return handle, sorted((r.query_id, r.poll_id, r.outcome, r.profile_text) for r in out)


def test_texts_of_repeats_are_not_held():
    listed = [_row("a", 10, 1), _row("a", 20, 2), _row("a", 30, 3)]
    handle, out = _settled(True, listed, [_answer("a", at, poll) for at, poll in ((10, 1), (20, 2), (30, 3))])
    assert out == [("a", 1, "collected", "text of a by 1"), ("a", 2, "dedup", None), ("a", 3, "dedup", None)]
    assert handle.states["fetches"].rows == []


def test_texts_that_may_be_wanted_are_held():
    # Poll 4 has not listed its row yet; poll 2 lists the id twice, later rows wait for the watermark.
    handle, out = _settled(True, [_row("a", 10, 1)], [_answer("a", 10, 1), _answer("a", 2000, 4)])
    assert [r[1] for r in handle.states["fetches"].rows] == [4]
    _, out = _settled(True, [_row("a", 2000, 4)], [], handle=handle)
    assert out == [("a", 4, "collected", "text of a by 4")]
    handle, out = _settled(False, [_row("a", 10, 1), _row("a", 20, 2)], [_answer("a", 10, 1), _answer("a", 20, 2)])
    assert out == [] and len(handle.states["fetches"].rows) == 2


def test_landing_leaves_no_staged_copy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    rows = spark.range(1000).selectExpr("id AS at", "repeat('word ', 50) AS text")
    files = land_in_turns(rows, "at", str(tmp_path / "landed"))
    assert files == 1 and spark.read.parquet(str(tmp_path / "landed")).count() == 1000
    assert not list((tmp_path / "shared").glob("landing-*"))
    assert len(list((tmp_path / "landed").glob("*.zstd.parquet"))) == 4


def test_past_batches_are_dropped_while_a_stream_runs():
    asked = []
    jvm = SimpleNamespace(System=SimpleNamespace(gc=lambda: asked.append(1)))
    spark = SimpleNamespace(sparkContext=SimpleNamespace(_jvm=jvm))
    ended = iter([False, False, True])
    session.run_to_end(spark, SimpleNamespace(awaitTermination=lambda seconds: next(ended)))
    assert len(asked) == 4
    assert session.STREAM_CONF["spark.sql.streaming.minBatchesToRetain"] == "2"
