"""Session settings for large runs, and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Settings an operator's plan relies on. Sizes are left to the cluster.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows carry profile texts of up to 10 MiB: keep scan tasks small.
    "spark.sql.files.maxPartitionBytes": "67108864",
    "spark.sql.session.timeZone": "UTC",
}
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # State holds texts: what is kept of it, here and in the checkpoint, is packed closely, and of
    # its versions the last two, which a restart needs.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}
#: How often a running stream has the shuffle files of its past micro-batches dropped.
COLLECT_SECONDS = 5


def local_session(cpus: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("profile-lake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**PLAN_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_dirs:
        _local_dirs.append(tempfile.mkdtemp(prefix="profile-lake-"))
        atexit.register(shutil.rmtree, _local_dirs[0], ignore_errors=True)
    return _local_dirs[0]


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or below the current :func:`scratch_folder`."""
    return f"{_run_folder.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path on it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def fixed_value(spark: SparkSession, path: str, value: int) -> int:
    """``value`` the first time; what was written then whenever it is asked again."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).selectExpr(f"cast({int(value)} as long) AS value").coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema("value long").json(path).first()[0]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system it is on."""
    files, target = file_system(spark, path)
    files.delete(target, True)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside the block are removed at its end.

    Frames built from them must be written before that.
    """
    path = scratch_path(spark, "run")
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        delete_path(spark, path)


def run_to_end(spark: SparkSession, query: StreamingQuery) -> None:
    """Wait until a stream ends.

    Spark drops the shuffle files of a micro-batch once its driver has collected the plan as
    garbage. A small plan leaves none for long, so that is asked for meanwhile, twice: what the
    first collection finds is released after it.
    """
    while not query.awaitTermination(COLLECT_SECONDS):
        for _ in range(2):
            gc.collect()
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: later reads neither recompute the input nor depend on the
    executors that made it. Texts repeat in what is staged, so it is packed closely.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
