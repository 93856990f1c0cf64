"""Per-host progress marks: progress(fe_host, last_event_time in ns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profile_lake.schemas import COLLECTED, DEDUP, UNFINISHED

PROGRESS_SCHEMA = "fe_host string, last_event_time long"
VERSION = "version="


def with_progress(rows: DataFrame, progress: DataFrame) -> DataFrame:
    """Add each host's ``last_event_time``, 0 when the host is new.

    The mark table has one row per host; Spark broadcasts it by its measured size.
    """
    marks = progress.select("fe_host", F.col("last_event_time").alias("_mark"))
    return rows.join(marks, "fe_host", "left").select(
        *rows.columns, F.coalesce("_mark", F.lit(0)).alias("last_event_time")
    )


def newer_than_progress(details: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows strictly after their host's mark."""
    return (
        with_progress(details, progress)
        .where(F.col("event_time") > F.col("last_event_time"))
        .drop("last_event_time")
    )


def advance(progress: DataFrame, outcomes: DataFrame) -> DataFrame:
    """New marks: the latest event of rows that need no further work.

    Rows whose profile was not found or failed do not move the mark, and a host without
    a qualifying row keeps its old one. Marks never go back.
    """
    reached = F.when(F.col("outcome").isin(COLLECTED, DEDUP, UNFINISHED), F.col("event_time"))
    fresh = outcomes.groupBy("fe_host").agg(F.max(reached).alias("last_event_time"))
    return (
        progress.select("fe_host", "last_event_time")
        .unionByName(fresh)
        .groupBy("fe_host")
        .agg(F.max("last_event_time").alias("last_event_time"))
        .where(F.col("last_event_time") > 0)
    )


def save_progress(progress: DataFrame, path: str, version: int) -> None:
    """Write the marks as a new version; readers see a version only when it is whole."""
    progress.write.mode("overwrite").json(f"{path}/{VERSION}{version}")


def load_progress(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The latest whole version of the marks and its number; (empty, -1) for none."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = -1
    if files.exists(root):
        for status in files.listStatus(root):
            folder = status.getPath()
            done = jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
            if folder.getName().startswith(VERSION) and files.exists(done):
                found = max(found, int(folder.getName()[len(VERSION) :]))
    if found < 0:
        return spark.createDataFrame([], PROGRESS_SCHEMA), found
    return spark.read.schema(PROGRESS_SCHEMA).json(f"{path}/{VERSION}{found}"), found
