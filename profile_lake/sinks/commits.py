"""Commit log of a table that is written batch by batch.

    <location>/year=…/hour=…/attempt=<batch>-<token>/part-….json    files, only ever added
    <location>/_commits/version=<n>/                                one version per commit

A writer adds its files under an attempt of its own, which no reader looks at, and then
commits: the version's ``_SUCCESS`` is what makes the batch visible, all of it at once. A
batch that is written again gets a new attempt; the later version replaces the earlier one
for readers that start after it, and readers that started before still find their files.
Nothing is renamed, and nothing is deleted but by :func:`remove_unnamed`.

A version holds the commits since the last whole one; every :data:`WHOLE_EVERY`-th holds
all commits in force. So a reader opens at most that many versions, however long the log.
One writer commits at a time, as the one driver of a stream does.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profile_lake.functions.columns import partition_keys
from profile_lake.schemas import PARTITION_COLUMNS, PROFILE_SCHEMA
from profile_lake.session import delete_path, file_system, path_exists

COMMIT_SCHEMA = "batch string, flush_us long, folder string, entries long, first_ts string, last_ts string"
WHOLE_EVERY = 20
#: Records of an id carry the same text. Side by side they shrink in the shuffle and in packed
#: files, and a shuffle by id needs no sort of whole records, as dealing them in turn does.
REBALANCE_BY = "sr_query_id"


@dataclass(frozen=True)
class Commit:
    """What one batch added: its folder below the location, its records and their range of ``ts``."""

    batch: str
    flush_us: int
    folder: str
    entries: int
    first_ts: str | None
    last_ts: str | None


def log_path(location: str) -> str:
    return f"{location}/_commits"


def has_commits(spark: SparkSession, location: str) -> bool:
    return path_exists(spark, log_path(location))


def folder_of(spark: SparkSession, flush_us: int) -> str:
    """year=YYYY/month=MM/day=DD/hour=HH of a flush time."""
    keys = spark.range(1).select(*partition_keys(F.lit(flush_us))).first()
    return "/".join(f"{name}={keys[name]}" for name in PARTITION_COLUMNS)


def add_files(
    records: DataFrame,
    location: str,
    flush_us: int,
    batch: str,
    batch_size: int | None = None,
    compression: str | None = None,
) -> Commit:
    """Write a batch's files, packed by ``compression`` if it is given. Readers do not see them before :func:`commit`."""
    folder = f"{folder_of(records.sparkSession, flush_us)}/attempt={batch}-{uuid.uuid4().hex[:12]}"
    written = Observation()
    counted = records.select(*PROFILE_SCHEMA.fieldNames()).observe(
        written, F.count(F.lit(1)).alias("entries"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    # Observed below the rebalancing shuffle, so that a second look at the shuffle counts nothing twice.
    files = counted.hint("rebalance", REBALANCE_BY).write.option("compression", compression or "none")
    files.option("maxRecordsPerFile", batch_size or 0).json(f"{location}/{folder}")
    seen = written.get
    return Commit(batch, flush_us, folder, seen["entries"], seen["first_ts"], seen["last_ts"])


def versions(spark: SparkSession, location: str) -> list[int]:
    """Numbers of the versions that are whole, ascending."""
    if not has_commits(spark, location):
        return []
    files, log = file_system(spark, log_path(location))
    names = (s.getPath().getName() for s in files.listStatus(log))
    numbers = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [n for n in numbers if path_exists(spark, f"{log_path(location)}/version={n}/_SUCCESS")]


def commits(spark: SparkSession, location: str, version: int | None = None) -> DataFrame:
    """The commits in force: one row per batch, as of ``version`` or the last one."""
    known = [n for n in versions(spark, location) if version is None or n <= version]
    if not known:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    whole = max((n for n in known if n % WHOLE_EVERY == 0), default=known[0])
    parts = [f"{log_path(location)}/version={n}" for n in known if n >= whole]
    rows = spark.read.option("basePath", log_path(location)).schema(f"{COMMIT_SCHEMA}, version long").json(parts)
    last = W.partitionBy("batch").orderBy(F.desc("version"))
    kept = rows.withColumn("_place", F.row_number().over(last)).where("_place = 1")
    return kept.drop("_place", "version")


def commit(spark: SparkSession, location: str, added: Commit) -> int:
    """Make a batch's files visible, in place of what the batch had before. Returns the version."""
    known = versions(spark, location)
    number = known[-1] + 1 if known else 0
    row = spark.createDataFrame([astuple(added)], COMMIT_SCHEMA)
    if number % WHOLE_EVERY == 0:
        row = commits(spark, location).where(F.col("batch") != added.batch).unionByName(row)
    # A version without its marker is a try that was lost: it is written over.
    row.coalesce(1).write.mode("overwrite").json(f"{log_path(location)}/version={number}")
    return number


def publish_batch(
    records: DataFrame,
    location: str,
    flush_us: int,
    batch: str,
    batch_size: int | None = None,
    compression: str | None = None,
) -> Commit:
    """Write a batch and commit it, once however often it runs.

    With a fixed flush time per batch, a repeat over the hour lands where the first try did.
    """
    added = add_files(records, location, flush_us, batch, batch_size, compression)
    commit(records.sparkSession, location, added)
    return added


def committed_folders(
    spark: SparkSession, location: str, ts_from: str | None = None, ts_to: str | None = None, version: int | None = None
) -> list[str]:
    """Folders of the commits that hold records with ``ts_from <= ts < ts_to``.

    The list is the reader's file listing, a path per flush: Spark's own is a path per file.
    """
    rows = commits(spark, location, version).where("entries > 0")
    if ts_from is not None:
        rows = rows.where(F.col("last_ts") >= ts_from)
    if ts_to is not None:
        rows = rows.where(F.col("first_ts") < ts_to)
    return sorted(f"{location}/{r.folder}" for r in rows.select("folder").collect())


def remove_unnamed(spark: SparkSession, location: str, older_than_seconds: int = 86400) -> int:
    """Delete attempts that no commit in force names, and versions before the last whole one.

    Only what is older than ``older_than_seconds`` goes, so that running readers and writers keep
    their files. Returns the number of attempts deleted.
    """
    latest = int((time.time() - older_than_seconds) * 1000)
    # The files are listed before the log is read: what is added in between is not on the list.
    files, pattern = file_system(spark, f"{location}/{'/'.join(f'{c}=*' for c in PARTITION_COLUMNS)}/attempt=*")
    listed = [
        "/".join(str(s.getPath()).split("/")[-len(PARTITION_COLUMNS) - 1 :])
        for s in files.globStatus(pattern) or []
        if s.getModificationTime() <= latest
    ]
    named = {r.folder for r in commits(spark, location).select("folder").collect()}
    unnamed = [folder for folder in listed if folder not in named]
    for folder in unnamed:
        delete_path(spark, f"{location}/{folder}")
    known = versions(spark, location)
    whole = max((n for n in known if n % WHOLE_EVERY == 0), default=0)
    for number in known:
        path = f"{log_path(location)}/version={number}"
        files, target = file_system(spark, path)
        if number < whole and files.getFileStatus(target).getModificationTime() <= latest:
            delete_path(spark, path)
    return len(unnamed)
