import pytest

import __spark_entry__ as entry
from profile_lake.plans.catalog import ORACLES, QUERIES
from profile_lake.schemas import PROFILE_SCHEMA

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_texts_meet_only_the_slowest(spark):
    plan = QUERIES["slowest_queries"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # The runs come staged and ranked; the texts' scan is joined to them once.
    assert plan.count("documents.parquet") + plan.count("Relation") <= 4 and plan.count("Join") == 1


def test_entry(spark):
    records = entry.entry(spark)
    assert records.columns == PROFILE_SCHEMA.fieldNames()
    assert records.count() == 441


@pytest.mark.parametrize(
    "name",
    ["parse_listings", "last_attempts", "ttl_dedup_resumed", "row_outcomes", "backoff_schedule",
     "daily_trend", "duration_regression", "compact_seen", "two_runs_outcomes", "landed_backoff", "fallback_records"],
)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = db.execute(ORACLES[name]).df()
    assert sorted(want.columns) == columns
    left = got.toPandas()[columns].astype(object)
    right = want[columns].astype(object)
    plain = [
        sorted(map(tuple, f.where(f.notna(), None).values.tolist()), key=repr) for f in (left, right)
    ]
    assert plain[0] == plain[1]
