import json

import pytest

from profile_lake.schemas import RESPONSE_SCHEMA
from profile_lake.sources import decode_listings, parse_query_detail, split_bad

from tests.helpers import listing, responses

ROW = {"eventTime": 7, "queryId": "q1", "state": "FINISHED", "latency": 1000}


def bodies(spark, *texts):
    return responses(spark, [listing(i, "h", t) for i, t in enumerate(texts)]).drop("query_id")


@pytest.mark.parametrize(
    "body, ids",
    [
        (json.dumps([ROW, {"queryId": "q2", "latency": -1}]), ["q1", "q2"]),
        ('{"data":[{"queryId":"q3","latency":2000}]}', ["q3"]),
        ('  {"data":[{"queryId":"q3"}], "more": {"x": [1]}} ', ["q3"]),
        ("[]", []),
        ("{}", []),
        ("null", []),
        ('{"data":null}', []),
        ('{"queryId":"solo"}', []),
        ("[null]", [""]),
        ('\n[{"queryId":"q"}]', ["q"]),
        ('\t\r\n [{"queryId":"q"}]\n', ["q"]),
        ('[{"queryId":"q","latency":null}]', ["q"]),
    ],
)
def test_good_bodies(spark, body, ids):
    good, bad = split_bad(bodies(spark, body))
    assert [r.query_id for r in good.orderBy("position").collect()] == ids
    assert bad.count() == 0


@pytest.mark.parametrize(
    "body",
    [
        "not json", "", '[{"queryId":"cut', '{"data":5}', '{"data":{"queryId":"x"}}', "5", '"x"',
        "[5]", "[] trailing", '[],"z":1', '[],"wrapped":{}', '[],"bad":null', '[]],"wrapped":[{}', "[],[]", '{},{"data":[]}',
        '{}}', "[]]", '{"data":[]},"bare":[{}]',
        '{"data":[]} x', "[{'queryId':'q'}]",
        '[{"queryId":"ok"},{"queryId":"d","latency":"12"}]',
        '[{"queryId":"d","latency":1.5}]', '[{"queryId":"d","latency":1e3}]',
        '[{"queryId":"d","latency":99999999999999999999}]', '[{"queryId":"d","isQuery":1}]',
    ],
)
def test_bad_bodies_give_no_rows(spark, body):
    good, bad = split_bad(bodies(spark, body))
    assert good.count() == 0
    assert [bytes(r.body).decode() for r in bad.collect()] == [body]


def test_missing_fields_take_zero_values(spark):
    row = parse_query_detail(bodies(spark, '[{"queryId":"q4"}]')).first()
    assert (row.query_id, row.state, row.sql_text, row.user) == ("q4", "", "", "")
    assert (row.latency, row.event_time, row.end_time_ms) == (0, 0, 0)


def test_cap_cuts_a_listing_into_a_bad_one(spark):
    good, bad = split_bad(bodies(spark, json.dumps([ROW])), max_bytes=20)
    assert (good.count(), bad.count()) == (0, 1)


def test_body_is_decoded_once(spark):
    plan = decode_listings(bodies(spark, "[]")).where("unreadable OR query_id = 'x'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1


def test_schema_of_responses():
    assert RESPONSE_SCHEMA.fieldNames()[-1] == "body"
