"""JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profile_lake.schemas import PROFILE_SCHEMA


def to_jsonl(records: DataFrame) -> DataFrame:
    """One JSON object per record in column ``value``, fields in record order.

    ``to_json`` leaves out nulls, and ``query_hash`` is the only nullable field.
    """
    return records.select(F.to_json(F.struct(*PROFILE_SCHEMA.fieldNames())).alias("value"))
