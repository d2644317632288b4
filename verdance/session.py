"""Session defaults and the shared folder used for checkpoints and stream tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MICROS = "spark.sql.parquet.outputTimestampType"
_made: list[str] = []
_tables: list[str] = []


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "verdance") -> SparkSession:
    """A session for tests and the local bench. On a cluster the submitter's
    settings apply and this is not called."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(MICROS, "TIMESTAMP_MICROS")  # the default format carries no statistics
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per column
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="verdance-")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, never used before; see ``remove_run_dirs``."""
    path = f"{shared_dir(spark)}/verdance/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def run_table(spark: SparkSession) -> str:
    """A new name in the session's catalog, never used before; see ``remove_run_dirs``."""
    name = f"verdance_{uuid.uuid4().hex}"
    _tables.append(name)
    return name


def remove_run_dirs(spark: SparkSession) -> None:
    """Drops the tables that ``run_table`` named so far and deletes the folders of ``run_dir``.
    Runs when the driver ends; a long-lived one calls it once nothing reads them any more."""
    while _made:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")


@atexit.register
def _remove_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):
            remove_run_dirs(spark)


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session with the stream settings: RocksDB state (W11), and a late
    filter that uses the current watermark (W6) rather than the previous one.

    Same context and catalog of files, own SQL settings, so the caller's session
    is left as it was. Valid for queries with one stateful operator.
    """
    s = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            s.conf.set(key, value)
    s.conf.set(MICROS, "TIMESTAMP_MICROS")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    s.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    return s
