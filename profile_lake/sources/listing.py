"""Query-listing bodies into rows.

A body is a JSON array of rows, or an object holding the array under ``data``. Both are
read in one strict pass: the body becomes a field of a small envelope object, so that a
wrong type or a cut-off body marks the whole response as bad. So does anything after the
body's value: text that would pass as more fields of the envelope does not pass as part
of an array's only element, and the other way round. The one leniency left is a number
where text is expected, which Spark reads as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profile_lake.functions.columns import body_text
from profile_lake.schemas import DETAIL_SCHEMA
from profile_lake.session import stage

_ROWS = T.ArrayType(DETAIL_SCHEMA)
_ENVELOPE = T.StructType(
    [
        T.StructField("bare", _ROWS),
        T.StructField("wrapped", T.StructType([T.StructField("data", _ROWS)])),
        T.StructField("bad", T.StringType()),
    ]
)
_STRICT = {
    "columnNameOfCorruptRecord": "bad",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

DETAIL_COLUMNS = [
    ("event_time", "eventTime"),
    ("query_id", "queryId"),
    ("state", "state"),
    ("database", "database"),
    ("sql_text", "sql"),
    ("user", "user"),
    ("start_time_ms", "startTime"),
    ("end_time_ms", "endTime"),
    ("latency", "latency"),
]


_BLANKS = " \t\r\n"


def _decoded(body: Column) -> Column:
    bare = F.substring(F.ltrim(body, F.lit(_BLANKS)), 1, 1) == "["
    shape = F.when(bare, "bare").otherwise("wrapped")
    return F.from_json(F.concat(F.lit('{"'), shape, F.lit('":'), body, F.lit("}")), _ENVELOPE, _STRICT)


def _is_one_value(body: Column) -> Column:
    """An array around the body has one element; null where it is no array at all."""
    return F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1


def decode_listings(responses: DataFrame, body: str = "body", max_bytes: int | None = None) -> DataFrame:
    """Rows of every body, decoded once, and one row with ``unreadable`` per bad response.

    Missing fields are '' or 0; ``position`` is null where a response has no rows. Only
    unreadable rows keep their body. Stage the result to use both kinds.
    """
    kind = responses.schema[body].dataType
    text = body_text(body, max_bytes) if isinstance(kind, T.BinaryType) else F.col(body)
    decoded = responses.withColumn("_text", text).withColumn(
        "_listing", F.when(_is_one_value(F.col("_text")), _decoded(F.col("_text")))
    )
    unreadable = F.col("_listing").isNull() | F.col("_listing.bad").isNotNull()
    # The condition sits inside the generator: as a filter Spark would push it
    # below the projection and decode every body twice.
    rows = F.when(~unreadable, F.coalesce(F.col("_listing.bare"), F.col("_listing.wrapped.data")))
    kept = [c for c in responses.columns if c != body]
    fields = []
    for name, source in DETAIL_COLUMNS:
        zero = "" if isinstance(DETAIL_SCHEMA[source].dataType, T.StringType) else 0
        fields.append(F.coalesce(F.col(f"_row.{source}"), F.lit(zero)).alias(name))
    flagged = decoded.select(*kept, body, unreadable.alias("unreadable"), F.posexplode_outer(rows).alias("position", "_row"))
    return flagged.select(*kept, F.when(F.col("unreadable"), F.col(body)).alias(body), "unreadable", "position", *fields)


def readable_rows(decoded: DataFrame, body: str = "body") -> DataFrame:
    """The rows of good bodies."""
    return decoded.where(F.col("position").isNotNull()).drop(body, "unreadable")


def unreadable_responses(decoded: DataFrame, responses_columns: list[str]) -> DataFrame:
    """The responses whose body could not be read, as they came."""
    return decoded.where("unreadable").select(*responses_columns)


def parse_query_detail(responses: DataFrame, body: str = "body", max_bytes: int | None = None) -> DataFrame:
    """Rows of every good body, with missing fields as '' or 0 and their position."""
    return readable_rows(decode_listings(responses, body, max_bytes), body)


def split_bad(
    responses: DataFrame, body: str = "body", max_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows of good bodies, whole responses whose body could not be read), decoded once."""
    decoded = stage(decode_listings(responses, body, max_bytes), "decoded")
    return readable_rows(decoded, body), unreadable_responses(decoded, responses.columns)
