"""The sample tables projected onto the schemas the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profile_lake.functions.columns import epoch_micros
from profile_lake.schemas import LISTING, PROFILE

LISTING_ROWS = 64


# Declared, so that opening a table reads no footers.
_SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    schema = _SCHEMAS[name]
    if not stream:
        return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
    # A pattern, since a stream takes a folder or a pattern but no single file.
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100)
    return files.parquet(f"{sf_dir}/{name}[.]parquet")


def query_log(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """One listed row per event; eight consecutive events share a query id."""
    return (
        _table(spark, sf_dir, "events", stream)
        .select("*", epoch_micros("ts").alias("event_us"))
        .selectExpr(
            "event_id",
            "event_us",
            "event_us div 1000 AS start_time_ms",
            "concat('q-', cast(event_id div 8 AS string)) AS query_id",
            "concat('fe-', cast(user_id % 3 AS string), ':8030') AS fe_host",
            "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING'"
            " ELSE 'FINISHED' END AS state",
            "concat('db', cast(user_id % 5 AS string)) AS database",
            "CASE WHEN event_id % 50 = 0 THEN ''"
            " ELSE concat('SELECT * FROM t WHERE k = ', get_json_object(props, '$.k')) END AS sql_text",
            "concat('u', user_id) AS user",
            "CASE WHEN event_type = 'signup' THEN -1L"
            " ELSE cast(floor(value * 100) AS bigint) END AS latency",
        )
        .selectExpr(
            "*",
            "event_us * 1000 AS event_time",
            "CASE WHEN state = 'RUNNING' THEN -1L ELSE start_time_ms + latency END AS end_time_ms",
        )
    )


def profile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile text by query id."""
    return _table(spark, sf_dir, "documents").select(
        F.concat(F.lit("q-"), F.col("doc_id")).alias("query_id"),
        F.col("text").alias("profile_text"),
    )


def poll_attempts(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """One poll of a host per event: (fe_host, poll_us, event_id, ok, duration_us)."""
    return _table(spark, sf_dir, "events", stream).select(
        F.expr("concat('fe-', cast(user_id % 3 as string), ':8030')").alias("fe_host"),
        epoch_micros("ts").alias("poll_us"),
        "event_id",
        (F.col("event_type") != "error").alias("ok"),
        F.round(F.col("value") * 100000).cast("long").alias("duration_us"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of requests: four consecutive events of a host retry one request."""
    return _table(spark, sf_dir, "events").select(
        F.expr("event_id div 4").alias("poll_id"),
        F.expr("concat('fe-', cast(user_id % 2 as string), ':8030')").alias("fe_host"),
        F.expr(f"case when event_id div 4 % 2 = 0 then '{LISTING}' else '{PROFILE}' end").alias(
            "endpoint"
        ),
        F.lit("").alias("query_id"),
        F.expr("cast(event_id % 4 + 1 as int)").alias("attempt"),
        F.when(F.col("event_type") == "error", 500)
        .when(F.col("event_type") == "signup", F.lit(None).cast("int"))
        .when(F.col("event_type") == "view", 404)
        .otherwise(200)
        .alias("status"),
        epoch_micros("ts").alias("started_us"),
        (epoch_micros("ts") + F.round(F.col("value") * 1000).cast("long")).alias("finished_us"),
    )


def listing_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing bodies of at most 64 rows each; odd polls use the wrapped envelope."""
    # An absent field reads back as ''.
    row = (
        "named_struct('eventTime', event_time, 'queryId', query_id, 'isQuery', true, 'state', state,"
        " 'database', database, 'sql', nullif(sql_text, ''), 'user', user,"
        " 'startTime', start_time_ms, 'endTime', end_time_ms, 'latency', latency, 'connId', event_id)"
    )
    return (
        query_log(spark, sf_dir)
        .selectExpr(f"event_id div {LISTING_ROWS} AS poll_id", "fe_host", "event_us", f"{row} AS row")
        .groupBy("poll_id", "fe_host")
        .agg(
            F.expr("to_json(array_sort(collect_list(row))) AS rows"),
            F.expr("min(event_us) AS started_us"),
            F.expr("max(event_us) AS finished_us"),
        )
        .selectExpr(
            "poll_id",
            "fe_host",
            f"'{LISTING}' AS endpoint",
            "'' AS query_id",
            "1 AS attempt",
            "200 AS status",
            "started_us",
            "finished_us",
            "cast(CASE WHEN poll_id % 2 = 1 THEN concat('{\"data\":', rows, '}') ELSE rows END"
            " AS binary) AS body",
        )
    )


def damaged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing bodies; those of every seventh poll are unreadable, in one of four ways.

    The last byte is missing, or text follows the value: a word, what would be more fields
    of an object, or more elements of an array. Every fifth poll has white space around.
    """
    text = F.col("body").cast("string")
    damaged = (
        F.when(F.col("poll_id") % 28 == 0, F.expr("substring(cast(body as string), 1, length(cast(body as string)) - 1)"))
        .when(F.col("poll_id") % 28 == 7, F.concat(text, F.lit(" x")))
        .when(F.col("poll_id") % 28 == 14, F.concat(text, F.lit(',"wrapped":{"data":[]}')))
        .otherwise(F.concat(text, F.lit(",[]")))
    )
    spaced = F.when(F.col("poll_id") % 5 == 0, F.concat(F.lit("\r\n\t "), text, F.lit("\n"))).otherwise(text)
    return listing_responses(spark, sf_dir).withColumn(
        "body", F.when(F.col("poll_id") % 7 == 0, damaged).otherwise(spaced).cast("binary")
    )


def polled_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged listings as polled: every eleventh poll is refused, the ones after it
    get their answer at the second attempt, a millisecond after the first."""
    answers = damaged_listings(spark, sf_dir)
    refused, retried = F.col("poll_id") % 11 == 0, F.col("poll_id") % 11 == 1
    failed = answers.where(refused | retried).withColumns({"status": F.lit(500), "body": F.lit("busy").cast("binary")})
    later = answers.where(~refused).withColumns(
        {
            "attempt": F.when(retried, 2).otherwise(1),
            "finished_us": F.col("finished_us") + F.when(retried, 1000).otherwise(0),
        }
    )
    return failed.unionByName(later)


def profile_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile response per document; every tenth is missing on its host."""
    missing = F.col("doc_id") % 10 == 0
    return _table(spark, sf_dir, "documents").select(
        F.expr("doc_id div 64").alias("poll_id"),
        F.expr("concat('fe-', cast(doc_id % 3 as string), ':8030')").alias("fe_host"),
        F.lit(PROFILE).alias("endpoint"),
        F.concat(F.lit("q-"), F.col("doc_id")).alias("query_id"),
        F.lit(1).alias("attempt"),
        F.when(missing, 404).otherwise(200).alias("status"),
        F.lit(0).cast("long").alias("started_us"),
        F.lit(0).cast("long").alias("finished_us"),
        F.when(missing, "not found").otherwise(F.col("text")).cast("binary").alias("body"),
    )


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a poller lands: listings, and a profile response per finished id of a poll.

    Ids without a document got no response; every tenth document is missing on its host.
    """
    listings = listing_responses(spark, sf_dir)
    asked = (
        query_log(spark, sf_dir)
        .where("state = 'FINISHED'")
        .selectExpr(f"event_id div {LISTING_ROWS} AS poll_id", "fe_host", "query_id")
        .distinct()
        .join(listings.select("poll_id", "fe_host", "finished_us"), ["poll_id", "fe_host"])
    )
    documents = _table(spark, sf_dir, "documents").selectExpr(
        "concat('q-', doc_id) AS query_id", "doc_id % 10 = 0 AS missing", "text"
    )
    profiles = asked.join(documents, "query_id").selectExpr(
        "poll_id",
        "fe_host",
        f"'{PROFILE}' AS endpoint",
        "query_id",
        "1 AS attempt",
        "CASE WHEN missing THEN 404 ELSE 200 END AS status",
        "finished_us AS started_us",
        "finished_us",
        "cast(CASE WHEN missing THEN 'not found' ELSE text END AS binary) AS body",
    )
    return listings.unionByName(profiles)


def retried_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed responses with attempts around them.

    Polls: those of rest 3 by 11 are answered at the second attempt, those of rest 5 by 13 are
    refused first and then answered, which no longer counts. Fetches, by the id's number:
    rest 2 by 7 finds nothing before it finds the text, rest 4 fails before it is answered,
    rest 6 fails three times. The answer that counts keeps its time.
    """
    landed = landed_responses(spark, sf_dir)
    listed, poll = F.col("endpoint") == LISTING, F.col("poll_id")
    rest = F.substring("query_id", 3, 18).cast("long") % 7
    second = F.when(listed, poll % 11 == 3).otherwise(rest == 4)
    refused = F.when(listed, poll % 13 == 5).otherwise(rest == 2)
    kept = F.when(listed, poll % 11 * 0).otherwise(rest) != 6

    def attempt(rows: DataFrame, number: int, status: int, body: str, after_us: int) -> DataFrame:
        return rows.withColumns(
            {
                "attempt": F.lit(number),
                "status": F.lit(status),
                "started_us": F.col("started_us") + after_us,
                "finished_us": F.col("finished_us") + after_us,
                "body": F.lit(body).cast("binary"),
            }
        )

    answers = landed.where(kept).withColumns(
        {
            "attempt": F.when(refused | second, 2).otherwise(1),
            "finished_us": F.col("finished_us") + F.when(refused, 1000).otherwise(0),
        }
    )
    parts = [
        answers,
        attempt(landed.where(kept & second & ~refused), 1, 500, "busy", -1000),
        attempt(landed.where(kept & refused & listed), 1, 403, "no", 0),
        attempt(landed.where(kept & refused & ~listed), 1, 404, "not found", 0),
        *[attempt(landed.where(~kept), n, 503, "busy", 1000 * n) for n in (1, 2, 3)],
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def host_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A carelessly written host list per event."""
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(
            "concat(' fe-', cast(user_id % 3 as string), ':8030 , ,fe-',"
            " cast(event_id % 5 as string), ':8030,')"
        ).alias("hosts"),
    )


def flush_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flushes of the sink, one per order: (flush_us, status, entries, duration_us, bytes)."""
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        epoch_micros("o_orderdate").alias("flush_us"),
        F.when(F.col("o_orderstatus") == "F", "error").otherwise("success").alias("status"),
        (F.col("o_custkey") % 1500).alias("entries"),
        F.round(F.col("o_totalprice") * 10).cast("long").alias("duration_us"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("bytes"),
    )
