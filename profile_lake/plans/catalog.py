"""Every operator as a query over the sample tables, with the same result in SQL.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds the SQL
where SQL can express it. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profile_lake.functions.columns import partition_keys
from profile_lake.operators import analytics, dedup, enrich, health, metrics, progress, records
from profile_lake.operators.segments import SeenSegments
from profile_lake.plans.collect import Collected, collect, collect_profiles
from profile_lake.schemas import DEDUP, LISTING, MICROS, PARTITION_COLUMNS, RESPONSE_SCHEMA, UNFINISHED
from profile_lake.session import delete_path, scratch_path, stage
from profile_lake.sinks import FallbackWriter, read_fallback, to_jsonl, write_profiles
from profile_lake.sinks.commits import publish_batch
from profile_lake.sources import (
    classify_response,
    decode_listings,
    parse_hosts,
    parse_query_detail,
    polls,
    profile_texts,
    read_profiles,
    read_responses,
    resolve_attempts,
    split_bad,
    stream_responses,
    tables,
    union_hosts,
)
from profile_lake.sources.profiles import decode_lines
from profile_lake.sources.responses import listings
from profile_lake.streaming import collect as stream_collect
from profile_lake.streaming import dedup as stream_dedup
from profile_lake.streaming import monitor
from profile_lake.streaming.landing import land_in_turns, land_out_of_order, turns_of
from profile_lake.streaming.marks import read_marks, read_seen, start_marks
from profile_lake.streaming.outcomes import read_outcomes, run_outcomes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CLUSTER = "main"
COLLECTED_AT = "2025-01-15T14:30:22Z"
FLUSH_US = 1736951422 * MICROS  # the same instant
TTL_US = 1800 * MICROS
# 2024-01-15 00:00:00 UTC: the state an earlier run left behind, and a "now"
EARLIER_US = 1705276800 * MICROS
SLOW_MS = 500.0

LOG_COLUMNS = [
    "event_time", "query_id", "fe_host", "state", "database", "sql_text", "user",
    "start_time_ms", "end_time_ms", "latency",
]

QUERY_LOG_SQL = """
query_log AS (
  SELECT event_id, epoch_us(ts) AS event_us, epoch_us(ts) * 1000 AS event_time,
    'q-' || CAST(event_id // 8 AS VARCHAR) AS query_id,
    'fe-' || CAST(user_id % 3 AS VARCHAR) || ':8030' AS fe_host,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING'
      ELSE 'FINISHED' END AS state,
    'db' || CAST(user_id % 5 AS VARCHAR) AS "database",
    CASE WHEN event_id % 50 = 0 THEN ''
      ELSE 'SELECT * FROM t WHERE k = ' || json_extract_string(props, '$.k') END AS sql_text,
    'u' || CAST(user_id AS VARCHAR) AS "user",
    epoch_us(ts) // 1000 AS start_time_ms,
    CASE WHEN event_type = 'signup' THEN -1
      ELSE epoch_us(ts) // 1000 + CAST(floor(value * 100) AS BIGINT) END AS end_time_ms,
    CASE WHEN event_type = 'signup' THEN -1
      ELSE CAST(floor(value * 100) AS BIGINT) END AS latency
  FROM events)"""

_RFC = "CASE WHEN {0} > 0 THEN strftime(make_timestamp({0} * 1000), '%Y-%m-%dT%H:%M:%SZ') ELSE '' END"

RECORD_SQL = f"""
    '{COLLECTED_AT}' AS ts, fe_host, '{CLUSTER}' AS cluster, query_id AS sr_query_id, state,
    "database", "user", {_RFC.format('start_time_ms')} AS start_time,
    {_RFC.format('end_time_ms')} AS end_time,
    CAST(greatest(latency, 0) AS DOUBLE) AS duration_ms, sql_text,
    CASE WHEN sql_text <> '' THEN md5(sql_text) END AS query_hash"""

# Finished rows as records without their texts: the base of the analyses.
RUNS_SQL = f"{QUERY_LOG_SQL}, runs AS (SELECT {RECORD_SQL}, start_time_ms FROM query_log WHERE state = 'FINISHED')"

FINISHED_SQL = f"{QUERY_LOG_SQL}, fin AS (SELECT * FROM query_log WHERE state = 'FINISHED')"


def ttl_sql(source: str, ttl_us: int = TTL_US) -> str:
    """Recursive CTE ``kept(query_id, at)`` over ``source(query_id, event_us)``."""
    return f"""kept AS (
  SELECT query_id, min(event_us) AS at FROM {source} GROUP BY query_id
  UNION ALL
  SELECT k.query_id, min(s.event_us) AS at FROM kept k JOIN {source} s
    ON s.query_id = k.query_id AND s.event_us > k.at + {ttl_us} GROUP BY k.query_id)"""


FIRST_SQL = f"""{FINISHED_SQL}, {ttl_sql('fin')}, accepted AS (
  SELECT f.* FROM fin f JOIN kept k ON k.query_id = f.query_id AND k.at = f.event_us
  QUALIFY row_number() OVER (PARTITION BY f.query_id, f.event_us ORDER BY f.fe_host, f.event_id) = 1)"""

# Outcomes with the documents as the answers to profile requests.
OUTCOME_SQL = f"""{FIRST_SQL}, outcomes AS (
  SELECT q.event_id, q.query_id, q.fe_host, q.event_time,
    CASE WHEN q.state <> 'FINISHED' THEN 'unfinished'
      WHEN a.event_id IS NULL THEN 'dedup'
      WHEN d.doc_id IS NULL THEN 'fetch_error'
      WHEN d.doc_id % 10 = 0 THEN 'not_found' ELSE 'collected' END AS outcome
  FROM query_log q LEFT JOIN accepted a ON a.event_id = q.event_id
    LEFT JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = q.query_id)"""

POLLS_SQL = """
polls AS (
  SELECT 'fe-' || CAST(user_id % 3 AS VARCHAR) || ':8030' AS fe_host, epoch_us(ts) AS poll_us,
    event_id, event_type <> 'error' AS ok, CAST(round(value * 100000) AS BIGINT) AS duration_us
  FROM events)"""

REQUESTS_SQL = """
requests AS (
  SELECT event_id // 4 AS poll_id, 'fe-' || CAST(user_id % 2 AS VARCHAR) || ':8030' AS fe_host,
    CASE WHEN event_id // 4 % 2 = 0 THEN 'query_detail' ELSE 'profile' END AS endpoint,
    CAST(event_id % 4 + 1 AS INTEGER) AS attempt,
    CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN NULL WHEN 'view' THEN 404
      ELSE 200 END AS status, epoch_us(ts) AS started_us
  FROM events), classed AS (
  SELECT *, CASE WHEN status IS NULL OR status >= 500 THEN 'retryable' WHEN status = 200 THEN 'ok'
    WHEN status = 404 AND endpoint = 'profile' THEN 'not_found' ELSE 'error' END AS response_class
  FROM requests)"""

FLUSHES_SQL = """
flushes AS (
  SELECT epoch_us(o_orderdate) AS flush_us,
    CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'success' END AS status,
    o_custkey % 1500 AS entries, CAST(round(o_totalprice * 10) AS BIGINT) AS duration_us,
    CAST(round(o_totalprice * 100) AS BIGINT) AS bytes
  FROM orders)"""

EARLIER_MARKS_SQL = f"""
marks AS (SELECT fe_host, max(event_time) AS last_event_time FROM query_log
  WHERE event_us < {EARLIER_US} GROUP BY fe_host)"""

EARLIER_SEEN_SQL = f"""
seen AS (SELECT query_id, min(event_us) AS first_seen_us FROM fin
  WHERE event_us < {EARLIER_US} GROUP BY query_id)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# --- bases ------------------------------------------------------------------------


def _collected_at() -> Column:
    return F.lit(COLLECTED_AT)


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.finished(tables.query_log(spark, sf_dir))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished rows as records without texts."""
    return records.to_record(_finished(spark, sf_dir), CLUSTER, _collected_at())


def _full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished rows that have a text, as whole records."""
    rows = enrich.enrich(_finished(spark, sf_dir), tables.profile_lookup(spark, sf_dir), ["query_id"])
    return records.to_record(rows, CLUSTER, _collected_at())


FULL_SQL = f"""{QUERY_LOG_SQL}, full_records AS (
  SELECT {RECORD_SQL}, d.text AS profile_text
  FROM query_log q JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = q.query_id
  WHERE q.state = 'FINISHED')"""


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_response(tables.profile_responses(spark, sf_dir)).select(
        "query_id",
        F.when(F.col("response_class") != "ok", F.col("response_class")).alias("skip_reason"),
    )


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.query_log(spark, sf_dir)
    first = dedup.label_first(records.finished(log), TTL_US)
    rest = log.where(~records.is_finished()).withColumn("is_first", F.lit(False))
    return enrich.classify(first.unionByName(rest), _fetches(spark, sf_dir), ["query_id"])


def _earlier_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        tables.query_log(spark, sf_dir)
        .where(F.col("event_us") < EARLIER_US)
        .groupBy("fe_host")
        .agg(F.max("event_time").alias("last_event_time"))
    )


def _earlier_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _finished(spark, sf_dir)
        .where(F.col("event_us") < EARLIER_US)
        .groupBy("query_id")
        .agg(F.min("event_us").alias("first_seen_us"))
    )


def _all_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, sf_dir).groupBy("query_id").agg(F.min("event_us").alias("first_seen_us"))


# --- sources ----------------------------------------------------------------------


@query(f"WITH {QUERY_LOG_SQL} SELECT {', '.join(f'"{c}"' for c in LOG_COLUMNS)} FROM query_log")
def parse_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing bodies of both envelopes into rows, absent fields as ''."""
    bodies = tables.listing_responses(spark, sf_dir).drop("query_id")
    return parse_query_detail(bodies).select(*LOG_COLUMNS)


@query(f"""WITH {QUERY_LOG_SQL} SELECT {', '.join(f'"{c}"' for c in LOG_COLUMNS)}
FROM query_log WHERE event_id // 64 % 7 <> 0""")
def good_listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the bodies that could be read whole."""
    bodies = tables.damaged_listings(spark, sf_dir).drop("query_id")
    return split_bad(bodies)[0].select(*LOG_COLUMNS)


@query(f"""WITH {QUERY_LOG_SQL} SELECT DISTINCT event_id // 64 AS poll_id, fe_host
FROM query_log WHERE event_id // 64 % 7 = 0""")
def dead_letter_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose body could not be read."""
    bodies = tables.damaged_listings(spark, sf_dir).drop("query_id")
    return split_bad(bodies)[1].select("poll_id", "fe_host")


@query("""SELECT 'q-' || CAST(doc_id AS VARCHAR) AS query_id, md5(text) AS text_md5,
FALSE AS truncated FROM documents WHERE doc_id % 10 <> 0""")
def scan_profile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile bodies as text under the size cap."""
    texts = profile_texts(tables.profile_responses(spark, sf_dir))
    return texts.select("query_id", F.md5("profile_text").alias("text_md5"), "truncated")


@query(f"""WITH {REQUESTS_SQL} SELECT poll_id, fe_host, endpoint, attempt, started_us,
response_class FROM classed""")
def classify_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_response(tables.request_log(spark, sf_dir)).select(
        "poll_id", "fe_host", "endpoint", "attempt", "started_us", "response_class"
    )


@query(f"""WITH {REQUESTS_SQL} SELECT poll_id, fe_host, endpoint, attempt, response_class
FROM classed QUALIFY row_number() OVER (
  PARTITION BY poll_id, fe_host, endpoint
  ORDER BY CASE WHEN response_class = 'retryable' THEN 1 ELSE 0 END,
    CASE WHEN response_class = 'retryable' THEN -attempt ELSE attempt END) = 1""")
def last_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempt that decides each request, of all that landed."""
    resolved = resolve_attempts(tables.request_log(spark, sf_dir))
    return classify_response(resolved).select(
        "poll_id", "fe_host", "endpoint", "attempt", "response_class"
    )


@query(f"""WITH {QUERY_LOG_SQL} SELECT fe_host, count(*) AS listed, min(event_time) AS first_event,
max(event_time) AS last_event FROM query_log GROUP BY fe_host""")
def host_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hosts' rows as one dataset."""
    return union_hosts(tables.query_log(spark, sf_dir)).groupBy("fe_host").agg(
        F.count(F.lit(1)).alias("listed"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


@query("""WITH lists AS (SELECT unnest(string_split(' fe-' || CAST(user_id % 3 AS VARCHAR) ||
  ':8030 , ,fe-' || CAST(event_id % 5 AS VARCHAR) || ':8030,', ',')) AS host FROM events)
SELECT trim(host) AS fe_host, count(*) AS named FROM lists WHERE trim(host) <> '' GROUP BY 1""")
def host_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts named by comma-separated lists."""
    named = tables.host_lists(spark, sf_dir).select(F.explode(parse_hosts("hosts")).alias("fe_host"))
    return named.groupBy("fe_host").agg(F.count(F.lit(1)).alias("named"))


@query(f"""WITH {FULL_SQL} SELECT *, '2025' AS "year", '01' AS "month", '15' AS "day",
'14' AS "hour" FROM full_records""")
def stored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as partitioned JSON lines and read back by their folder."""
    path = scratch_path(spark, "profiles")
    write_profiles(_full_records(spark, sf_dir), path, FLUSH_US, compression="gzip")
    return read_profiles(spark, path).where("year = '2025' AND month = '01' AND hour = '14'")


_FROM, _TO = "2024-01-08T00:00:00Z", "2024-01-22T00:00:00Z"


@query(f"""WITH {FULL_SQL} SELECT * REPLACE (end_time AS ts) FROM full_records
WHERE end_time >= '{_FROM}' AND end_time < '{_TO}'""")
def profiles_of_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two weeks of a table committed in eight batches by time, one of them twice: the range of ``ts``
    chooses the commits."""
    path = scratch_path(spark, "committed")
    dated = _full_records(spark, sf_dir).withColumn("ts", F.col("end_time"))
    clock = F.unix_micros(F.to_timestamp("ts"))
    for number, (part, high) in enumerate(turns_of(dated.withColumn("_at", clock), "_at", 8)):
        for _ in range(2 if number == 3 else 1):
            publish_batch(part.drop("_at"), path, high, str(number), compression="gzip")
    return read_profiles(spark, path, _FROM, _TO).drop(*PARTITION_COLUMNS)


# --- sinks and encoding ------------------------------------------------------------


@query(f"WITH {FULL_SQL} SELECT * FROM full_records")
def json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON lines and back."""
    return decode_lines(to_jsonl(_full_records(spark, sf_dir)))


@query(f"""WITH {FULL_SQL}, encoded AS (
  SELECT octet_length(encode(CAST(to_json(full_records) AS VARCHAR))) -
    CASE WHEN query_hash IS NULL THEN octet_length(encode('"query_hash":null,')) ELSE 0 END AS n
  FROM full_records)
SELECT count(*) AS entries, CAST(sum(n + 1) AS BIGINT) AS bytes FROM encoded""")
def json_lines_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes the records take as JSON lines."""
    return metrics.encoded_bytes(to_jsonl(_full_records(spark, sf_dir)))


@query(f"""WITH {QUERY_LOG_SQL} SELECT event_id, strftime(make_timestamp(event_us), '%Y') AS "year",
strftime(make_timestamp(event_us), '%m') AS "month", strftime(make_timestamp(event_us), '%d') AS "day",
strftime(make_timestamp(event_us), '%H') AS "hour" FROM query_log""")
def folder_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values of a flush time."""
    log = tables.query_log(spark, sf_dir)
    return log.select("event_id", *partition_keys("event_us")).select("event_id", *PARTITION_COLUMNS)


# --- projections and filters -------------------------------------------------------


@query(f"WITH {QUERY_LOG_SQL} SELECT {RECORD_SQL} FROM query_log")
def project_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint, times and clamped duration of every listed row."""
    return records.to_record(tables.query_log(spark, sf_dir), CLUSTER, _collected_at())


@query(f"WITH {FINISHED_SQL} SELECT event_id, query_id, fe_host, event_us FROM fin")
def finished_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, sf_dir).select("event_id", "query_id", "fe_host", "event_us")


@query(f"""WITH {QUERY_LOG_SQL}, {EARLIER_MARKS_SQL} SELECT q.event_id, q.fe_host, q.event_time
FROM query_log q LEFT JOIN marks m USING (fe_host)
WHERE q.event_time > coalesce(m.last_event_time, 0)""")
def newer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after the mark an earlier run left."""
    log = tables.query_log(spark, sf_dir)
    return progress.newer_than_progress(log, _earlier_marks(spark, sf_dir)).select(
        "event_id", "fe_host", "event_time"
    )


@query(f"""WITH {QUERY_LOG_SQL}, {EARLIER_MARKS_SQL} SELECT q.event_id, q.fe_host,
coalesce(m.last_event_time, 0) AS last_event_time FROM query_log q LEFT JOIN marks m USING (fe_host)""")
def progress_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.query_log(spark, sf_dir)
    return progress.with_progress(log, _earlier_marks(spark, sf_dir)).select(
        "event_id", "fe_host", "last_event_time"
    )


@query(f"WITH {RUNS_SQL} SELECT sr_query_id, fe_host, start_time, duration_ms FROM runs WHERE duration_ms >= {SLOW_MS}")
def slow_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.slow(_runs(spark, sf_dir), SLOW_MS).select(
        "sr_query_id", "fe_host", "start_time", "duration_ms"
    )


# --- deduplication -----------------------------------------------------------------


@query(f"""WITH {FINISHED_SQL} SELECT event_id, query_id, fe_host, event_us FROM fin
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY event_us, fe_host, event_id) = 1""")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each id."""
    return dedup.first_occurrence(_finished(spark, sf_dir)).select(
        "event_id", "query_id", "fe_host", "event_us"
    )


@query(f"WITH RECURSIVE {FIRST_SQL} SELECT event_id, query_id, fe_host, event_us FROM accepted")
def ttl_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows accepted under the TTL."""
    return dedup.ttl_dedup(_finished(spark, sf_dir), TTL_US).select(
        "event_id", "query_id", "fe_host", "event_us"
    )


@query(f"""WITH RECURSIVE {FINISHED_SQL}, {EARLIER_SEEN_SQL}, open_rows AS (
  SELECT f.* FROM fin f LEFT JOIN seen s USING (query_id)
  WHERE s.first_seen_us IS NULL OR f.event_us - s.first_seen_us > {TTL_US}),
{ttl_sql('open_rows')}
SELECT o.event_id, o.query_id, o.fe_host, o.event_us FROM open_rows o
  JOIN kept k ON k.query_id = o.query_id AND k.at = o.event_us
QUALIFY row_number() OVER (PARTITION BY o.query_id, o.event_us ORDER BY o.fe_host, o.event_id) = 1""")
def ttl_dedup_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, continuing from the ids an earlier run accepted."""
    return dedup.ttl_dedup(_finished(spark, sf_dir), TTL_US, _earlier_seen(spark, sf_dir)).select(
        "event_id", "query_id", "fe_host", "event_us"
    )


@query(f"""WITH {FINISHED_SQL}, {EARLIER_SEEN_SQL} SELECT event_id, query_id FROM fin
WHERE query_id NOT IN (SELECT query_id FROM seen)""")
def unseen_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_seen(_finished(spark, sf_dir), _earlier_seen(spark, sf_dir)).select(
        "event_id", "query_id"
    )


@query(f"""WITH RECURSIVE {FIRST_SQL}, {EARLIER_SEEN_SQL}, merged AS (
  SELECT * FROM seen UNION ALL SELECT query_id, event_us FROM accepted)
SELECT query_id, max(first_seen_us) AS first_seen_us FROM merged GROUP BY query_id""")
def merge_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known ids with the newly accepted ones."""
    accepted = dedup.ttl_dedup(_finished(spark, sf_dir), TTL_US)
    return dedup.merge_seen(_earlier_seen(spark, sf_dir), accepted)


_WEEK_US = 7 * 86400 * MICROS


@query(f"""WITH RECURSIVE {FINISHED_SQL}, {ttl_sql('fin', _WEEK_US)} SELECT query_id, max(k.at) AS first_seen_us
FROM kept k GROUP BY query_id HAVING max(k.at) >= (SELECT max(event_us) FROM fin) - {_WEEK_US}""")
def segmented_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live seen set after five batches, each of which looked its own ids up and added what it accepted."""
    state = SeenSegments(spark, scratch_path(spark, "segments"), _WEEK_US, kept=2)
    version = -1
    for version, (part, high) in enumerate(turns_of(_finished(spark, sf_dir), "event_us", 5)):
        fresh = dedup.ttl_dedup(part, _WEEK_US, state.lookup(part, version - 1))
        state.add(fresh.select("query_id", F.col("event_us").alias("first_seen_us")), version, high)
    return state.whole(version)


@query(f"""WITH {FINISHED_SQL}, every AS (
  SELECT query_id, min(event_us) AS first_seen_us FROM fin GROUP BY query_id)
SELECT * FROM every WHERE first_seen_us >= {EARLIER_US - _WEEK_US}""")
def compact_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known ids that are still inside their TTL."""
    return dedup.compact_seen(_all_seen(spark, sf_dir), EARLIER_US, _WEEK_US)


# --- joins and outcomes ------------------------------------------------------------


@query(f"""WITH RECURSIVE {FIRST_SQL} SELECT {RECORD_SQL}, d.text AS profile_text
FROM accepted q JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = q.query_id""")
def collected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: finished, first under the TTL, with text, as records."""
    return collect_profiles(
        tables.query_log(spark, sf_dir),
        tables.profile_lookup(spark, sf_dir),
        CLUSTER,
        _collected_at(),
        TTL_US,
    )


@query(f"WITH {FULL_SQL} SELECT sr_query_id, fe_host, start_time, profile_text FROM full_records")
def enrich_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished rows with their profile text."""
    return _full_records(spark, sf_dir).select("sr_query_id", "fe_host", "start_time", "profile_text")


@query(f"WITH RECURSIVE {OUTCOME_SQL} SELECT event_id, query_id, fe_host, outcome FROM outcomes")
def row_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every listed row."""
    return _outcomes(spark, sf_dir).select("event_id", "query_id", "fe_host", "outcome")


_OTHER_SQL = """other AS (SELECT sql_text, CAST(substr("database", 3) AS BIGINT) AS system,
  count(*) AS n FROM query_log GROUP BY 1, 2),
known AS (SELECT md5(sql_text) AS query_hash, count(*) AS other_rows,
  CAST(sum(n) AS BIGINT) AS other_runs FROM other WHERE sql_text <> '' GROUP BY 1)"""


def _other_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another system's log: statements counted per system."""
    system = F.substring("database", 3, 10).cast("long").alias("system")
    return tables.query_log(spark, sf_dir).groupBy("sql_text", system).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {RUNS_SQL}, {_OTHER_SQL} SELECT r.sr_query_id, r.fe_host, r.start_time, r.query_hash,
k.other_rows, k.other_runs FROM runs r JOIN known k USING (query_hash)""")
def correlate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with the other log's figures for the same statement."""
    return analytics.correlate(_runs(spark, sf_dir), _other_log(spark, sf_dir), "sql_text", "n").select(
        "sr_query_id", "fe_host", "start_time", "query_hash", "other_rows", "other_runs"
    )


@query(f"""WITH {RUNS_SQL}, {_OTHER_SQL}, ours AS (SELECT query_hash, count(*) AS runs,
  sum(duration_ms) AS total_ms FROM runs WHERE query_hash IS NOT NULL GROUP BY 1)
SELECT * FROM ours JOIN known USING (query_hash)""")
def correlate_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements known to both systems."""
    return analytics.correlate_statements(
        _runs(spark, sf_dir), _other_log(spark, sf_dir), "sql_text", "n"
    )


# --- the whole pipeline over landed responses ---------------------------------------

# 2024-01-30 00:00:00 UTC: the time of the run
NOW_US = 1706572800 * MICROS

PIPELINE_SQL = f"""{QUERY_LOG_SQL}, arrived AS (
  SELECT *, max(event_us) OVER (PARTITION BY event_id // 64, fe_host) AS arrival FROM query_log),
fin AS (SELECT * FROM arrived WHERE state = 'FINISHED'),
arrivals AS (SELECT DISTINCT query_id, arrival AS event_us FROM fin), {ttl_sql('arrivals')},
accepted AS (
  SELECT f.* FROM fin f JOIN kept k ON k.query_id = f.query_id AND k.at = f.arrival
  QUALIFY row_number() OVER (PARTITION BY f.query_id, f.arrival ORDER BY f.event_time) = 1),
outcomes AS (
  SELECT q.*, d.text, CASE WHEN q.state <> 'FINISHED' THEN 'unfinished'
      WHEN a.event_id IS NULL THEN 'dedup'
      WHEN d.doc_id IS NULL THEN 'fetch_error'
      WHEN d.doc_id % 10 = 0 THEN 'not_found' ELSE 'collected' END AS outcome
  FROM arrived q LEFT JOIN accepted a ON a.event_id = q.event_id
    LEFT JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = q.query_id)"""

_PIPELINE_RECORDS_SQL = f"""WITH RECURSIVE {PIPELINE_SQL} SELECT
{RECORD_SQL.replace(COLLECTED_AT, '2024-01-30T00:00:00Z')}, text AS profile_text
FROM outcomes WHERE outcome = 'collected'"""


def _pipeline(spark: SparkSession, sf_dir: str) -> Collected:
    seen = spark.createDataFrame([], "query_id string, first_seen_us long")
    marks = spark.createDataFrame([], progress.PROGRESS_SCHEMA)
    return collect(_landed(spark, sf_dir), seen, marks, CLUSTER, NOW_US, TTL_US)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses as files, scanned back."""
    path = scratch_path(spark, "landed")
    tables.landed_responses(spark, sf_dir).write.parquet(path)
    return read_responses(spark, path)


@query(_PIPELINE_RECORDS_SQL)
def pipeline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one run over landed responses."""
    return _pipeline(spark, sf_dir).records


@query(f"WITH RECURSIVE {PIPELINE_SQL} SELECT fe_host, query_id, event_time, outcome FROM outcomes")
def pipeline_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every listed row of the run."""
    return _pipeline(spark, sf_dir).outcomes.select("fe_host", "query_id", "event_time", "outcome")


@query(f"""WITH RECURSIVE {PIPELINE_SQL} SELECT fe_host, max(event_time) AS last_event_time
FROM outcomes WHERE outcome IN ('collected', 'dedup', 'unfinished') GROUP BY fe_host""")
def pipeline_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks after the run."""
    return _pipeline(spark, sf_dir).progress


@query(f"""WITH RECURSIVE {PIPELINE_SQL} SELECT query_id, max(arrival) AS first_seen_us FROM accepted
GROUP BY query_id HAVING max(arrival) >= {NOW_US - TTL_US}""")
def pipeline_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids still inside their TTL after the run."""
    return _pipeline(spark, sf_dir).seen


@query(f"WITH RECURSIVE {PIPELINE_SQL} SELECT fe_host, query_id, event_time, outcome FROM outcomes")
def two_runs_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections in turn, the second from the first's seen set: no id twice in its TTL."""
    seen = spark.createDataFrame([], "query_id string, first_seen_us long")
    marks = spark.createDataFrame([], progress.PROGRESS_SCHEMA)
    outcomes = []
    for part, high in turns_of(tables.landed_responses(spark, sf_dir), "finished_us", 2):
        done = collect(part, seen, marks, CLUSTER, high, TTL_US)
        seen = stage(done.seen, "seen")
        outcomes.append(done.outcomes)
    return union_hosts(*outcomes).select("fe_host", "query_id", "event_time", "outcome")


# --- progress, counters, histograms -----------------------------------------------


_MARKS_SQL = f"""WITH RECURSIVE {OUTCOME_SQL}, {EARLIER_MARKS_SQL}, candidates AS (
  SELECT * FROM marks UNION ALL SELECT fe_host, max(event_time) FROM outcomes
  WHERE outcome IN ('collected', 'dedup', 'unfinished') GROUP BY fe_host)
SELECT fe_host, max(last_event_time) AS last_event_time FROM candidates GROUP BY fe_host"""


@query(_MARKS_SQL)
def progress_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New mark of every host."""
    return progress.advance(_earlier_marks(spark, sf_dir), _outcomes(spark, sf_dir))


@query(_MARKS_SQL)
def saved_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks saved as a version and loaded again."""
    path = scratch_path(spark, "progress")
    progress.save_progress(_earlier_marks(spark, sf_dir), path, 0)
    old, version = progress.load_progress(spark, path)
    progress.save_progress(progress.advance(old, _outcomes(spark, sf_dir)), path, version + 1)
    return progress.load_progress(spark, path)[0]


@query(f"WITH {POLLS_SQL} SELECT fe_host, count(*) AS polls_total FROM polls GROUP BY fe_host")
def polls_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.polls_by_host(tables.poll_attempts(spark, sf_dir))


@query(f"""WITH RECURSIVE {OUTCOME_SQL} SELECT fe_host, count(*) AS profiles_collected_total
FROM outcomes WHERE outcome = 'collected' GROUP BY fe_host""")
def collected_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.collected_by_host(_outcomes(spark, sf_dir))


@query(f"""WITH RECURSIVE {OUTCOME_SQL} SELECT outcome AS reason, count(*) AS profiles_skipped_total
FROM outcomes WHERE outcome IN ('dedup', 'not_found', 'fetch_error') GROUP BY outcome""")
def skipped_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.skipped_by_reason(_outcomes(spark, sf_dir))


def _histogram_sql(source: str, keys: str, value: str, bounds: str, scale: int) -> str:
    by = f"GROUP BY {keys}" if keys else ""
    comma = f"t.{keys}, " if keys else ""
    on = f"ON s.{keys} = t.{keys}" if keys else "ON TRUE"
    keyed = f"{keys}, " if keys else ""
    return f"""bounds(le, b) AS (VALUES {bounds}, ('+Inf', NULL)),
totals AS (SELECT {keyed}CAST(sum({value}) AS DOUBLE) / {scale} AS sum_value, count(*) AS total_count
  FROM {source} {by})
SELECT {comma}b.le, count(CASE WHEN b.b IS NULL OR s.{value} <= b.b THEN 1 END) AS bucket_count,
  any_value(t.sum_value) AS sum_value, any_value(t.total_count) AS total_count
FROM totals t JOIN {source} s {on} CROSS JOIN bounds b GROUP BY {comma}b.le"""


_POLL_BOUNDS = """('0.01', 10000), ('0.05', 50000), ('0.1', 100000), ('0.25', 250000),
('0.5', 500000), ('1', 1000000), ('2.5', 2500000), ('5', 5000000), ('10', 10000000), ('30', 30000000)"""
_FLUSH_BOUNDS = """('0.01', 10000), ('0.05', 50000), ('0.1', 100000), ('0.25', 250000),
('0.5', 500000), ('1', 1000000), ('2.5', 2500000), ('5', 5000000), ('10', 10000000)"""
_ENTRY_BOUNDS = """('1', 1), ('5', 5), ('10', 10), ('25', 25), ('50', 50), ('100', 100),
('250', 250), ('500', 500), ('1000', 1000)"""


@query(f"WITH {POLLS_SQL}, {_histogram_sql('polls', 'fe_host', 'duration_us', _POLL_BOUNDS, MICROS)}")
def poll_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.poll_durations(tables.poll_attempts(spark, sf_dir))


@query(f"WITH {FLUSHES_SQL} SELECT status, count(*) AS flushes_total FROM flushes GROUP BY status")
def flushes_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.flushes_by_status(tables.flush_log(spark, sf_dir))


@query(f"""WITH {FLUSHES_SQL}, good AS (SELECT * FROM flushes WHERE status = 'success'),
{_histogram_sql('good', '', 'entries', _ENTRY_BOUNDS, 1)}""")
def entries_per_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.entries_per_flush(tables.flush_log(spark, sf_dir))


@query(f"WITH {FLUSHES_SQL}, {_histogram_sql('flushes', '', 'duration_us', _FLUSH_BOUNDS, MICROS)}")
def flush_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.flush_durations(tables.flush_log(spark, sf_dir))


@query(f"""WITH {FLUSHES_SQL} SELECT
CAST(sum(CASE WHEN status = 'success' THEN bytes ELSE 0 END) AS BIGINT) AS bytes_written_total,
max(CASE WHEN status = 'success' THEN flush_us // 1000000 END) AS last_flush_timestamp_seconds,
CAST(sum(CASE WHEN status = 'error' THEN entries ELSE 0 END) AS BIGINT) AS fallback_writes_total
FROM flushes""")
def flush_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.flush_totals(tables.flush_log(spark, sf_dir))


# --- host health -------------------------------------------------------------------

def _backoff_sql(polls: str, tie: str) -> str:
    return f"""{polls}, streaks AS (
  SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY fe_host ORDER BY poll_us, {tie}
    ROWS UNBOUNDED PRECEDING) AS streak FROM polls),
counted AS (
  SELECT *, CASE WHEN ok THEN 0 ELSE CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (
    PARTITION BY fe_host, streak ORDER BY poll_us, {tie} ROWS UNBOUNDED PRECEDING) AS BIGINT) END
    AS failures FROM streaks),
schedule AS (
  SELECT *, CAST(least(300, 10 * power(2, least(failures, 30) - 1)) AS BIGINT) AS delay_s
  FROM counted),
latest AS (SELECT * FROM schedule
  QUALIFY row_number() OVER (PARTITION BY fe_host ORDER BY poll_us DESC, {tie} DESC) = 1),
clock AS (SELECT max(poll_us) AS now_us FROM polls)"""


_BACKOFF_SQL = _backoff_sql(POLLS_SQL, "event_id")
_POLLABLE_SQL = """SELECT fe_host FROM latest, clock
WHERE NOT (failures > 0 AND poll_us + delay_s * 1000000 > now_us)"""


@query(f"""WITH {_BACKOFF_SQL} SELECT fe_host, event_id, failures, delay_s,
poll_us + delay_s * 1000000 AS next_retry_us FROM schedule WHERE failures > 0""")
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay after every failed poll."""
    schedule = health.backoff_schedule(tables.poll_attempts(spark, sf_dir))
    return schedule.where(F.col("failures") > 0).select(
        "fe_host", "event_id", "failures", "delay_s", "next_retry_us"
    )


@query(f"WITH {_BACKOFF_SQL} {_POLLABLE_SQL}")
def pollable_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts outside their back-off window at the time of the last poll."""
    made = tables.poll_attempts(spark, sf_dir)
    now_us = made.agg(F.max("poll_us")).first()[0]
    state = health.host_state(health.backoff_schedule(made))
    return health.pollable_hosts(made.select("fe_host").distinct(), state, now_us)


# The same from landed responses: refused, retried and unreadable listings among them.
LANDED_POLLS_SQL = f"""{QUERY_LOG_SQL}, polls AS (
  SELECT fe_host, event_id // 64 AS poll_id, min(event_us) AS poll_us,
    event_id // 64 % 11 <> 0 AND event_id // 64 % 7 <> 0 AS ok,
    max(event_us) - min(event_us) + CASE WHEN event_id // 64 % 11 = 1 THEN 1000 ELSE 0 END AS duration_us
  FROM query_log GROUP BY fe_host, event_id // 64)"""
_LANDED_BACKOFF_SQL = _backoff_sql(LANDED_POLLS_SQL, "poll_id")


def _landed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = stage(tables.polled_listings(spark, sf_dir), "polled")
    return polls(responses, decode_listings(listings(responses)))


@query(f"WITH {LANDED_POLLS_SQL} SELECT fe_host, poll_id, poll_us, ok, duration_us FROM polls")
def landed_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls, their success and duration, from raw responses."""
    return _landed_polls(spark, sf_dir)


@query(f"WITH {LANDED_POLLS_SQL} SELECT fe_host, count(*) AS polls_total FROM polls GROUP BY fe_host")
def landed_polls_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.polls_by_host(_landed_polls(spark, sf_dir))


@query(f"WITH {LANDED_POLLS_SQL}, {_histogram_sql('polls', 'fe_host', 'duration_us', _POLL_BOUNDS, MICROS)}")
def landed_poll_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.poll_durations(_landed_polls(spark, sf_dir))


@query(f"""WITH {_LANDED_BACKOFF_SQL} SELECT fe_host, poll_id, failures, delay_s,
poll_us + delay_s * 1000000 AS next_retry_us FROM schedule WHERE failures > 0""")
def landed_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay after every failed poll; an unreadable body is a failure."""
    schedule = health.backoff_schedule(_landed_polls(spark, sf_dir), ties=("poll_id",))
    return schedule.where(F.col("failures") > 0).select("fe_host", "poll_id", "failures", "delay_s", "next_retry_us")


@query(f"WITH {_LANDED_BACKOFF_SQL} {_POLLABLE_SQL}")
def landed_pollable_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = stage(_landed_polls(spark, sf_dir), "polls")
    now_us = made.agg(F.max("poll_us")).first()[0]
    state = health.host_state(health.backoff_schedule(made, ties=("poll_id",)), ties=("poll_id",))
    return health.pollable_hosts(made.select("fe_host").distinct(), state, now_us)


# --- analyses ----------------------------------------------------------------------


def _trend_sql(grain: str, dimensions: str) -> str:
    return f"""WITH {RUNS_SQL} SELECT CAST(date_trunc('{grain}', make_timestamp(start_time_ms * 1000))
  AS TIMESTAMP)::VARCHAR AS period, {dimensions}, count(*) AS runs,
  round(sum(duration_ms) / count(*), 6) AS avg_ms,
  round(quantile_cont(duration_ms, 0.5), 6) AS p50_ms,
  round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms,
  round(quantile_cont(duration_ms, 0.99), 6) AS p99_ms, max(duration_ms) AS max_ms
FROM runs GROUP BY ALL"""


def _trend(spark: SparkSession, sf_dir: str, grain: str, dimensions: list[str]) -> DataFrame:
    trend = analytics.duration_trend(_runs(spark, sf_dir), grain, dimensions)
    rounded = {c: F.round(c, 6) for c in ("avg_ms", "p50_ms", "p95_ms", "p99_ms")}
    return trend.withColumns({"period": F.col("period").cast("string"), **rounded})


@query(_trend_sql("hour", 'cluster, "database"'))
def hourly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir, "hour", ["cluster", "database"])


@query(_trend_sql("day", 'cluster, "database", "user", query_hash'))
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir, "day", ["cluster", "database", "user", "query_hash"])


@query(_trend_sql("week", 'query_hash'))
def weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir, "week", ["query_hash"])


@query(_trend_sql("month", 'cluster'))
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir, "month", ["cluster"])


@query(_trend_sql("hour", 'cluster, "database"').replace("round(quantile_cont", "(quantile_disc").replace("), 6) AS p", ")) AS p"))
def hourly_trend_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched percentiles; at this accuracy the sketch holds every value of a group."""
    trend = analytics.duration_trend_approx(_runs(spark, sf_dir), "hour", ["cluster", "database"])
    return trend.withColumns({"period": F.col("period").cast("string"), "avg_ms": F.round("avg_ms", 6)})


@query(f"""WITH {RUNS_SQL}, total AS (SELECT sum(duration_ms) AS t FROM runs WHERE query_hash IS NOT NULL)
SELECT query_hash, count(*) AS runs, count(DISTINCT "user") AS users, min(start_time) AS first_seen,
max(start_time) AS last_seen, sum(duration_ms) AS total_ms,
round(sum(duration_ms) / any_value(t), 9) AS share
FROM runs, total WHERE query_hash IS NOT NULL GROUP BY query_hash""")
def statement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = analytics.statement_summary(_runs(spark, sf_dir))
    return summary.withColumn("share", F.round("share", 9))


@query(f"""WITH {FULL_SQL} SELECT sr_query_id, fe_host, start_time, duration_ms, profile_text
FROM full_records ORDER BY duration_ms DESC, sr_query_id, fe_host, start_time LIMIT 20""")
def slowest_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 slowest runs that have a text, with their texts, which only the winners fetch."""
    texts = tables.profile_lookup(spark, sf_dir).withColumnRenamed("query_id", "sr_query_id")
    known = _runs(spark, sf_dir).drop("profile_text").join(texts.select("sr_query_id"), "sr_query_id", "left_semi")
    best = stage(analytics.top_slow(known, 20), "slowest")
    return analytics.with_texts(best, texts).select(
        "sr_query_id", "fe_host", "start_time", "duration_ms", "profile_text"
    )


@query(f"""WITH {RUNS_SQL} SELECT fe_host, sr_query_id, start_time, duration_ms, place FROM (
  SELECT *, row_number() OVER (PARTITION BY fe_host
    ORDER BY duration_ms DESC, sr_query_id, start_time) AS place FROM runs) WHERE place <= 10""")
def slowest_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 slowest runs of each host."""
    best = analytics.top_slow_by(_runs(spark, sf_dir), ["fe_host"], 10)
    return best.select(
        "fe_host", "sr_query_id", "start_time", "duration_ms", F.col("place").cast("long").alias("place")
    )


@query(f"""WITH {RUNS_SQL}, placed AS (
  SELECT query_hash, sr_query_id, fe_host, start_time, duration_ms,
    lag(duration_ms) OVER w AS previous_ms,
    sum(duration_ms) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS s,
    count(*) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS n
  FROM runs WHERE query_hash IS NOT NULL
  WINDOW w AS (PARTITION BY query_hash ORDER BY start_time, sr_query_id, fe_host, duration_ms))
SELECT query_hash, sr_query_id, fe_host, start_time, duration_ms,
  coalesce(previous_ms, -1) AS previous_ms, coalesce(round(s / n, 6), -1) AS trailing_avg_ms,
  coalesce(round(CASE WHEN s > 0 THEN duration_ms / (s / n) END, 6), -1) AS ratio FROM placed""")
def duration_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run against the ten before it of the same statement; -1 where there is none."""
    compared = analytics.duration_regression(_runs(spark, sf_dir), trailing=10)
    absent = F.lit(-1.0)
    return compared.select(
        "query_hash", "sr_query_id", "fe_host", "start_time", "duration_ms",
        F.coalesce("previous_ms", absent).alias("previous_ms"),
        F.coalesce(F.round("trailing_avg_ms", 6), absent).alias("trailing_avg_ms"),
        F.coalesce(F.round("ratio", 6), absent).alias("ratio"),
    )


# --- streams over the same tables ---------------------------------------------------


@query(ORACLES["ttl_dedup"])
def stream_ttl_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact TTL rule as a stream, run to the end of its input."""
    return stream_dedup.drain_events(spark, sf_dir, TTL_US)


# The landed responses with attempts around them: refused polls list nothing, the first
# final answer of a fetch counts.
RETRIED_SQL = PIPELINE_SQL.replace(
    "FROM query_log),", "FROM query_log WHERE event_id // 64 % 13 <> 5),"
).replace(
    "WHEN d.doc_id IS NULL THEN 'fetch_error'", "WHEN d.doc_id IS NULL OR d.doc_id % 7 = 6 THEN 'fetch_error'"
).replace("WHEN d.doc_id % 10 = 0 THEN", "WHEN d.doc_id % 10 = 0 OR d.doc_id % 7 = 2 THEN")

# Responses come up to four days late; the watermark follows five days behind.
LATE_DAYS = 5


def _closing(spark: SparkSession) -> DataFrame:
    """An answer without rows."""
    empty = (-1, "none", LISTING, "", 1, 200, 0, 0, b"[]")
    return spark.createDataFrame([empty], RESPONSE_SCHEMA)


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """The retried responses, out of order, through the tagged stream; the folder of its tables."""
    base = scratch_path(spark, "tagged")
    rows = tables.retried_responses(spark, sf_dir)
    key = F.xxhash64("poll_id", "fe_host", "query_id", "attempt")
    files = land_out_of_order(rows, key, "finished_us", f"{base}/landed", LATE_DAYS, _closing(spark))
    run_outcomes(
        stream_responses(spark, f"{base}/landed", max_files=files), base, CLUSTER, lambda: NOW_US,
        ttl_us=TTL_US, lateness=f"{LATE_DAYS} days", in_order=False, compression="gzip",
    )
    return base


@query(f"WITH RECURSIVE {RETRIED_SQL} SELECT fe_host, query_id, event_time, outcome FROM outcomes")
def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every listed row, from one streaming query over responses with retries,
    whose attempts, listings and fetches come out of order in four micro-batches."""
    return read_outcomes(spark, _streamed(spark, sf_dir)).select("fe_host", "query_id", "event_time", "outcome")


@query(ORACLES["ttl_dedup"])
def stream_ttl_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The TTL rule over rows that come up to four days late: the rows of an id are spread over
    four micro-batches, whatever their order."""
    return stream_dedup.drain_shuffled(spark, sf_dir, TTL_US, LATE_DAYS)


@query(f"""WITH RECURSIVE {RETRIED_SQL} SELECT
{RECORD_SQL.replace(COLLECTED_AT, '2024-01-30T00:00:00Z')}, text AS profile_text
FROM outcomes WHERE outcome = 'collected'""")
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records from one streaming query over responses with retries, landed in order."""
    landed = scratch_path(spark, "landed")
    files = land_in_turns(tables.retried_responses(spark, sf_dir), "finished_us", landed)
    return stream_collect.drain(spark, landed, CLUSTER, NOW_US, TTL_US, files)


# Two streams in turn: the second gets every tenth poll, and all from two thirds of them on.
_TURN_SQL = "CASE WHEN event_id // 64 % 10 = 0 OR event_id // 64 * 3 >= 2 * (max(event_id // 64) OVER ()) THEN 2 ELSE 1 END"


@query(f"""WITH RECURSIVE {QUERY_LOG_SQL}, turned AS (SELECT *, {_TURN_SQL} AS turn FROM query_log),
arrived AS (SELECT *, max(event_us) OVER (PARTITION BY event_id // 64, fe_host) AS arrival FROM turned
  WHERE event_id // 64 % 13 <> 5),
one AS (SELECT query_id, arrival AS event_us FROM arrived WHERE turn = 1 AND state = 'FINISHED'), {ttl_sql('one')},
kept_one AS (SELECT * FROM kept),
first_of AS (
  SELECT f.event_id FROM arrived f JOIN kept_one k ON k.query_id = f.query_id AND k.at = f.arrival
  WHERE turn = 1 AND state = 'FINISHED'
  QUALIFY row_number() OVER (PARTITION BY f.query_id, f.arrival ORDER BY f.event_time) = 1),
reached_one AS (
  SELECT a.fe_host, a.event_time FROM arrived a LEFT JOIN first_of f ON f.event_id = a.event_id
    LEFT JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = a.query_id
  WHERE turn = 1 AND (state <> 'FINISHED' OR f.event_id IS NULL
    OR (d.doc_id IS NOT NULL AND d.doc_id % 7 NOT IN (2, 6) AND d.doc_id % 10 <> 0))),
mark AS (SELECT fe_host, max(event_time) AS t FROM reached_one GROUP BY fe_host),
fresh AS (SELECT a.* FROM arrived a LEFT JOIN mark m ON m.fe_host = a.fe_host
  WHERE turn = 2 AND a.event_time > coalesce(m.t, 0)),
two AS (SELECT query_id, arrival AS event_us FROM fresh WHERE state = 'FINISHED'),
last_one AS (SELECT k.query_id, max(k.at) AS at FROM kept_one k GROUP BY k.query_id),
kept_two AS (
  SELECT s.query_id, min(s.event_us) AS at FROM two s LEFT JOIN last_one l ON l.query_id = s.query_id
  WHERE l.at IS NULL OR s.event_us > l.at + {TTL_US} GROUP BY s.query_id
  UNION ALL
  SELECT k.query_id, min(s.event_us) AS at FROM kept_two k JOIN two s
    ON s.query_id = k.query_id AND s.event_us > k.at + {TTL_US} GROUP BY k.query_id),
second_of AS (
  SELECT f.event_id FROM fresh f JOIN kept_two k ON k.query_id = f.query_id AND k.at = f.arrival WHERE state = 'FINISHED'
  QUALIFY row_number() OVER (PARTITION BY f.query_id, f.arrival ORDER BY f.event_time) = 1),
reached AS (
  SELECT fe_host, t AS event_time FROM mark UNION ALL
  SELECT a.fe_host, a.event_time FROM fresh a LEFT JOIN second_of f ON f.event_id = a.event_id
    LEFT JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = a.query_id
  WHERE state <> 'FINISHED' OR f.event_id IS NULL
    OR (d.doc_id IS NOT NULL AND d.doc_id % 7 NOT IN (2, 6) AND d.doc_id % 10 <> 0)),
counted AS (
  SELECT a.fe_host, count(*) FILTER (state <> 'FINISHED') AS unfinished_after,
    count(*) FILTER (state = 'FINISHED' AND f.event_id IS NULL) AS dedup_after
  FROM fresh a LEFT JOIN second_of f ON f.event_id = a.event_id GROUP BY a.fe_host)
SELECT r.fe_host, max(r.event_time) AS last_event_time, any_value(coalesce(unfinished_after, 0)) AS unfinished_after,
  any_value(coalesce(dedup_after, 0)) AS dedup_after
FROM reached r LEFT JOIN counted c ON c.fe_host = r.fe_host GROUP BY r.fe_host""")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of a stream, and of a second one with a new checkpoint that goes on from the first
    one's marks and accepted ids, both read back from its state; and what the second one saw."""
    base = scratch_path(spark, "marks")
    responses, staged = tables.retried_responses(spark, sf_dir), f"{base}/responses"
    responses.write.option("compression", "zstd").parquet(staged)
    rows = spark.read.schema(responses.schema).parquet(staged)
    last = tables.query_log(spark, sf_dir).agg(F.max(F.expr(f"event_id div {tables.LISTING_ROWS}"))).first()[0] or 0
    later = (F.col("poll_id") % 10 == 0) | (F.col("poll_id") * 3 >= 2 * last)
    found, seen = spark.createDataFrame([], progress.PROGRESS_SCHEMA), None
    for run, part in (("first", rows.where(~later)), ("second", rows.where(later))):
        part.write.option("compression", "zstd").parquet(f"{base}/landed-{run}")
    delete_path(spark, staged)
    for run in ("first", "second"):
        run_outcomes(
            stream_responses(spark, f"{base}/landed-{run}"), f"{base}/{run}", CLUSTER, lambda: NOW_US, run,
            ttl_us=TTL_US, progress=found, seen=seen, compression="gzip",
        )
        start_marks(spark, f"{base}/{run}/outcomes", f"{base}/marks-{run}").awaitTermination()
        found = stage(read_marks(spark, f"{base}/marks-{run}", found), "marks")
        seen = stage(read_seen(spark, f"{base}/{run}/checkpoint-{run}"), "seen")
        # Both are known: the next stream starts without what this one read and held.
        delete_path(spark, f"{base}/landed-{run}")
        delete_path(spark, f"{base}/{run}/checkpoint-{run}")
    count = lambda kind: F.count(F.when(F.col("outcome") == kind, 1))
    after = read_outcomes(spark, f"{base}/second").groupBy("fe_host").agg(
        count(UNFINISHED).alias("unfinished_after"), count(DEDUP).alias("dedup_after")
    )
    return found.join(after, "fe_host", "left").na.fill(0, ["unfinished_after", "dedup_after"])


@query(_PIPELINE_RECORDS_SQL.replace("2024-01-30T00:00:00Z", "collected"))
def replayed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the batch pipeline inside a stream that restarts after every micro-batch."""
    base = stream_collect.replay(tables.landed_responses(spark, sf_dir), CLUSTER, TTL_US)
    written = read_profiles(spark, f"{base}/table").drop(*PARTITION_COLUMNS)
    return written.withColumn("ts", F.lit("collected"))


@query(f"""WITH RECURSIVE {PIPELINE_SQL} SELECT fe_host, max(event_time) AS last_event_time
FROM outcomes WHERE outcome IN ('collected', 'dedup', 'unfinished') GROUP BY fe_host""")
def replayed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks after the last of those micro-batches."""
    base = stream_collect.replay(tables.landed_responses(spark, sf_dir), CLUSTER, TTL_US)
    return progress.load_progress(spark, f"{base}/state/progress")[0]


@query(f"WITH {FINISHED_SQL} SELECT DISTINCT query_id FROM fin")
def stream_builtin_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in rule under a TTL longer than the log: every id once."""
    return stream_dedup.drain_builtin(spark, sf_dir, "3650 days")


@query(f"""WITH RECURSIVE {OUTCOME_SQL} SELECT
  strftime(time_bucket(INTERVAL 5 MINUTES, make_timestamp(event_time // 1000)), '%Y-%m-%d %H:%M:%S') AS window_start,
  fe_host, count(CASE WHEN outcome = 'collected' THEN 1 END) AS collected,
  count(CASE WHEN outcome <> 'collected' THEN 1 END) AS skipped FROM outcomes GROUP BY ALL""")
def stream_interval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes per host and five minutes, counted by a stream."""
    outcomes = _outcomes(spark, sf_dir).select("fe_host", "event_us", "outcome")
    return monitor.drain_interval_counts(outcomes)


@query(f"""WITH {FINISHED_SQL} SELECT f.event_id, f.query_id, f.fe_host,
  CASE WHEN d.doc_id % 3 <> 1 THEN md5(d.text) END AS text_md5
FROM fin f LEFT JOIN documents d ON 'q-' || CAST(d.doc_id AS VARCHAR) = f.query_id""")
def stream_late_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed rows with texts that come a minute later; those of a third of the documents come
    an hour later, when their rows have been returned without."""
    return stream_collect.drain_late_profiles(spark, sf_dir)


@query(f"WITH {FULL_SQL} SELECT * FROM full_records")
def fallback_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records flushed in four batches, one of them twice and one to a store that fails:
    what the table and the fallback hold together."""
    base = scratch_path(spark, "fallback")
    records_ = stage(_full_records(spark, sf_dir), "records")
    part = F.pmod(F.xxhash64("sr_query_id"), F.lit(4))
    for number in range(4):
        store = "unreachable://store/table" if number == 2 else f"{base}/table"
        writer = FallbackWriter(store, f"{base}/fallback", f"{base}/log", lambda: FLUSH_US, compression="gzip")
        for _ in range(2 if number == 1 else 1):
            writer(records_.where(part == number), number)
    written = read_profiles(spark, f"{base}/table").drop(*PARTITION_COLUMNS)
    return written.unionByName(read_fallback(spark, f"{base}/fallback").drop("batch_id"))


@query(f"""WITH {POLLS_SQL} SELECT strftime(time_bucket(INTERVAL 5 MINUTES, make_timestamp(poll_us)),
  '%Y-%m-%d %H:%M:%S') AS window_start, fe_host, count(*) AS polls,
  count(CASE WHEN NOT ok THEN 1 END) AS failed FROM polls GROUP BY ALL""")
def stream_poll_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls and failures per host and five minutes, counted by a stream."""
    return monitor.drain_poll_counts(spark, sf_dir)
