"""Writing records as Hive-partitioned JSON lines.

    <location>/year=YYYY/month=MM/day=DD/hour=HH/part-….json

The folder is the flush time in UTC. :mod:`commits` is the form for batches that may be repeated. Any URI Hadoop can write to works: ``gs://`` with
the cloud connector, ``s3a://`` with its options, a shared or local folder.
"""

from __future__ import annotations

import sys
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from profile_lake.functions.columns import partition_keys
from profile_lake.schemas import MICROS, PARTITION_COLUMNS, PROFILE_SCHEMA
from profile_lake.session import delete_path, fixed_value, scratch_folder, stage
from profile_lake.sinks.commits import REBALANCE_BY, has_commits, publish_batch
from profile_lake.sinks.jsonl import to_jsonl

FLUSH_LOG_SCHEMA = (
    "batch_id long, flush_us long, status string, entries long, duration_us long, bytes long"
)
# Ours: the prefix used when none is given.
DEFAULT_PREFIX = "query-profiles"


@dataclass(frozen=True)
class Sink:
    """Where records go. ``location`` is None for the console."""

    backend: str
    location: str | None = None
    hadoop_options: Mapping[str, str] = field(default_factory=dict)
    #: Records per file; None leaves files to the size of the tasks' output.
    batch_size: int | None = None

    def configure(self, spark: SparkSession) -> None:
        """Set the connector's options on the session."""
        for key, value in self.hadoop_options.items():
            spark.conf.set(f"spark.hadoop.{key}", value)
            spark.sparkContext._jsc.hadoopConfiguration().set(key, value)


def sink_for(options: Mapping[str, str | int]) -> Sink:
    """Sink for ``backend`` gcs, s3, file or stdout with its options.

    gcs, s3: bucket (required), prefix; s3 also region and endpoint, where an endpoint
    switches to path-style addressing. file: output_dir, prefix. All: batch_size, the most
    records per file (no limit by default; collectors that need small files use
    ``schemas.BATCH_SIZE``).
    """
    backend = str(options.get("backend", "gcs"))
    batch_size = int(options["batch_size"]) if options.get("batch_size") else None
    prefix = str(options.get("prefix", DEFAULT_PREFIX)).strip("/")
    if backend in ("gcs", "s3"):
        bucket = options.get("bucket")
        if not bucket:
            raise ValueError(f"bucket is required for the {backend} backend")
        if backend == "gcs":
            return Sink(backend, f"gs://{bucket}/{prefix}", batch_size=batch_size)
        hadoop = {}
        if options.get("region"):
            hadoop["fs.s3a.endpoint.region"] = str(options["region"])
        if options.get("endpoint"):
            hadoop["fs.s3a.endpoint"] = str(options["endpoint"])
            hadoop["fs.s3a.path.style.access"] = "true"
        return Sink(backend, f"s3a://{bucket}/{prefix}", hadoop, batch_size)
    if backend == "file":
        root = str(options.get("output_dir", "./output")).rstrip("/")
        return Sink(backend, f"{root}/{prefix}", batch_size=batch_size)
    if backend == "stdout":
        return Sink(backend, batch_size=batch_size)
    raise ValueError(f"unknown backend {backend!r}: use gcs, s3, file or stdout")


def with_partitions(records: DataFrame, flush_us: int) -> DataFrame:
    """Records with the flush time's year, month, day and hour."""
    return records.select(*PROFILE_SCHEMA.fieldNames(), *partition_keys(F.lit(flush_us)))


def write_profiles(
    records: DataFrame,
    path: str,
    flush_us: int,
    batch_size: int | None = None,
    even_files: bool = True,
    compression: str | None = None,
) -> None:
    """Append records under the folder of ``flush_us``.

    ``even_files`` spends a shuffle so that files have the size Spark aims at, however
    many small tasks made the records; Spark splits what an id crowds. Without it each task
    writes its own file. ``compression`` names a codec for the files; readers need not know it.
    ``batch_size`` limits the records of a file. Into a table with a commit log the records
    go as a batch of their own.
    """
    if has_commits(records.sparkSession, path):
        publish_batch(records, path, flush_us, f"append-{uuid.uuid4().hex[:12]}", batch_size, compression)
        return
    rows = with_partitions(records, flush_us)
    if even_files:
        rows = rows.hint("rebalance", REBALANCE_BY)
    (
        rows.write.partitionBy(*PARTITION_COLUMNS)
        .mode("append")
        .option("compression", compression or "none")
        .option("maxRecordsPerFile", batch_size or 0)
        .json(path)
    )


def print_lines(records: DataFrame) -> None:
    """Every record as one JSON line on the driver's output, a partition at a time."""
    for row in to_jsonl(records).toLocalIterator():
        sys.stdout.write(row.value + "\n")
    sys.stdout.flush()


def write_records(records: DataFrame, sink: Sink, flush_us: int) -> None:
    """One flush to the backend a sink names; the console gets JSON lines."""
    if sink.location is None:
        print_lines(records)
    else:
        sink.configure(records.sparkSession)
        write_profiles(records, sink.location, flush_us, sink.batch_size)


def read_flush_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FLUSH_LOG_SCHEMA).json(path)


def read_fallback(spark: SparkSession, path: str) -> DataFrame:
    """Records of failed flushes, with the batch they belong to."""
    return spark.read.schema(f"{PROFILE_SCHEMA.toDDL()}, batch_id long").json(path)


class FallbackWriter:
    """``foreachBatch`` function: write a batch, and on failure keep it elsewhere.

    A batch's flush time is written down at its first try and used again by repeats, its
    commit is replaced, and a success removes what the fallback kept of it: every record
    is in one place once. The batch is staged first, so only the store's failures count
    as such. Each flush has one row in the flush log.
    """

    def __init__(
        self,
        location: str,
        fallback_path: str,
        log_path: str,
        clock_us: Callable[[], int] = lambda: int(time.time() * MICROS),
        batch_size: int | None = None,
        compression: str | None = None,
    ) -> None:
        self.location = location
        self.fallback_path = fallback_path
        self.log_path = log_path
        self.clock_us = clock_us
        self.batch_size = batch_size
        self.compression = compression

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        started = self.clock_us()
        flush_us = fixed_value(spark, f"{self.log_path}/_begun/batch={batch_id}", started)
        kept = f"{self.fallback_path}/batch_id={batch_id}"
        with scratch_folder(spark):
            counted, counts = _counted(batch.select(*PROFILE_SCHEMA.fieldNames()))
            records = stage(counted, "flush")
            entries, size = counts()
            try:
                publish_batch(records, self.location, flush_us, str(batch_id), self.batch_size, self.compression)
                status = "success"
            except Exception:  # any failure of the store: the records must survive
                records.write.mode("overwrite").option("compression", self.compression or "none").json(kept)
                status, size = "error", 0
            else:
                delete_path(spark, kept)
        took = self.clock_us() - started
        row = (batch_id, flush_us, status, entries, took, size)
        log = spark.createDataFrame([row], FLUSH_LOG_SCHEMA)
        log.write.mode("overwrite").json(f"{self.log_path}/batch={batch_id}")


def _counted(records: DataFrame) -> tuple[DataFrame, Callable[[], tuple[int, int]]]:
    """Records that count themselves and their encoded bytes while they are written."""
    seen = Observation()
    line = F.to_json(F.struct(*PROFILE_SCHEMA.fieldNames()))
    counted = records.observe(
        seen,
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(F.octet_length(line) + 1), F.lit(0)).alias("bytes"),
    )
    return counted, lambda: (seen.get["entries"], seen.get["bytes"])
