"""Scans over landed raw responses, and which response of a request counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profile_lake.functions.columns import body_text
from profile_lake.schemas import (
    FETCH_ERROR,
    LISTING,
    NOT_FOUND,
    PROFILE,
    RESPONSE_SCHEMA,
)

REQUEST_KEYS = ["poll_id", "fe_host", "endpoint", "query_id"]

OK = "ok"
RETRYABLE = "retryable"
ERROR = "error"


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch scan of landed responses. JSON files carry the body base64-encoded."""
    return spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def stream_responses(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int = 1000
) -> DataFrame:
    """Streaming scan of the same files, at most ``max_files`` per micro-batch."""
    return (
        spark.readStream.schema(RESPONSE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .format(fmt)
        .load(path)
    )


def polls(responses: DataFrame, decoded: DataFrame) -> DataFrame:
    """One row per poll of a host: (fe_host, poll_id, poll_us, ok, duration_us).

    A poll is good if the answer that decides its listing is a 200 that could be read
    (``decoded``: the listing responses through ``decode_listings``); a bad body backs a
    host off like a refusal. It lasts from its first request to its last answer, profile
    fetches and repeated attempts included.
    """
    span = poll_log(responses).groupBy("fe_host", "poll_id").agg(
        F.min("started_us").alias("poll_us"), (F.max("finished_us") - F.min("started_us")).alias("duration_us")
    )
    deciding = resolve_attempts(poll_log(responses).where(F.col("endpoint") == LISTING))
    bad = decoded.where("unreadable").select("poll_id", "fe_host", "attempt", F.lit(True).alias("_bad")).distinct()
    good = deciding.join(bad, ["poll_id", "fe_host", "attempt"], "left").select(
        "poll_id", "fe_host", ((F.col("status") == 200) & F.col("_bad").isNull()).alias("ok")
    )
    return span.join(good, ["poll_id", "fe_host"]).select(
        "fe_host", "poll_id", "poll_us", F.coalesce("ok", F.lit(False)).alias("ok"), "duration_us"
    )


def poll_log(responses: DataFrame) -> DataFrame:
    """The responses without their bodies; the scan then never reads them."""
    return responses.drop("body")


def parse_hosts(hosts: Column | str) -> Column:
    """A comma-separated host list as an array without blanks."""
    text = F.col(hosts) if isinstance(hosts, str) else hosts
    names = F.transform(F.split(text, ","), lambda host: F.trim(host))
    return F.filter(names, lambda host: host != "")


def union_hosts(*frames: DataFrame) -> DataFrame:
    """Rows of every host's frame as one dataset. Hosts landed in one folder need one scan."""
    return reduce(DataFrame.unionByName, frames)


def response_class() -> Column:
    status, endpoint = F.col("status"), F.col("endpoint")
    return (
        F.when(status.isNull() | (status >= 500), RETRYABLE)
        .when(status == 200, OK)
        .when((status == 404) & (endpoint == PROFILE), NOT_FOUND)
        .otherwise(ERROR)
    )


def classify_response(responses: DataFrame) -> DataFrame:
    """Add ``response_class``: ok, not_found, retryable or error."""
    return responses.withColumn("response_class", response_class())


def resolve_attempts(responses: DataFrame, retries: int | None = None) -> DataFrame:
    """One row per request: the earliest final answer, else the last failed attempt.

    All landed attempts count; ``retries`` leaves out those beyond ``1 + retries``. Spark
    limits each task to one row per request before the shuffle. Pass frames without
    ``body``, and join bodies last.
    """
    retryable = response_class() == RETRYABLE
    preferred = Window.partitionBy(*REQUEST_KEYS).orderBy(
        retryable.cast("int"),
        F.when(retryable, -F.col("attempt")).otherwise(F.col("attempt")),
        "started_us",
    )
    considered = responses if retries is None else responses.where(F.col("attempt") <= 1 + retries)
    return (
        considered.withColumn("_choice", F.row_number().over(preferred))
        .where(F.col("_choice") == 1)
        .drop("_choice")
    )


def fetch_outcome() -> Column:
    """How a resolved profile response counts: null for text, else a skip reason."""
    kind = response_class()
    return F.when(kind == NOT_FOUND, NOT_FOUND).when(kind != OK, FETCH_ERROR)


def profile_texts(
    responses: DataFrame, max_bytes: int | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Texts of successful profile responses, with their request and arrival.

    Texts are whole unless ``max_bytes`` is given.
    """
    cut = F.lit(False) if max_bytes is None else F.octet_length("body") > max_bytes
    return responses.where((F.col("endpoint") == PROFILE) & (F.col("status") == 200)).select(
        "poll_id",
        "fe_host",
        "query_id",
        "attempt",
        "finished_us",
        body_text("body", max_bytes).alias("profile_text"),
        cut.alias("truncated"),
        *extra,
    )


def listings(responses: DataFrame) -> DataFrame:
    """Successful listing responses."""
    return responses.where((F.col("endpoint") == LISTING) & (F.col("status") == 200))
