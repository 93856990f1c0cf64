"""Progress marks of a running stream.

The marks are the state of a second streaming query over the outcomes the first one
writes: one row per host, summed up in every task before it is shuffled, so a host with a
third of all rows is no hot key. They are read back from the state of its checkpoint; a
new checkpoint of the collection starts from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from profile_lake.operators.progress import advance
from profile_lake.schemas import COLLECTED, DEDUP, UNFINISHED

OUTCOMES = "fe_host string, event_time long, outcome string"
#: Outcomes that need no further work.
REACHED = (COLLECTED, DEDUP, UNFINISHED)


def start_marks(spark: SparkSession, outcomes: str, checkpoint: str) -> StreamingQuery:
    """Bring the marks up to all outcomes written so far below the folder ``outcomes``."""
    rows = spark.readStream.schema(OUTCOMES).option("ignoreMissingFiles", "true").parquet(f"{outcomes}/*")
    reached = rows.where(F.col("outcome").isin(*REACHED)).groupBy("fe_host").agg(F.max("event_time").alias("reached"))
    return (
        reached.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_marks(spark: SparkSession, checkpoint: str, start: DataFrame) -> DataFrame:
    """progress(fe_host, last_event_time): what the checkpoint's state holds, never behind ``start``."""
    state = spark.read.format("statestore").load(checkpoint)
    held = state.select(F.col("key.fe_host").alias("fe_host"), F.col("value.max").alias("event_time"))
    return advance(start, held.withColumn("outcome", F.lit(COLLECTED)))


def read_seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """seen(query_id, first_seen_us): the last accepted instant of every id still inside its TTL,
    from the state of a checkpoint of :func:`outcomes.tagged_outcomes`."""
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "last").load(checkpoint)
    return state.select("list_element.query_id", F.col("list_element.at").alias("first_seen_us"))
