"""Window tables and files."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.model import STATS, WINDOW_STATS
from verdance.operators.tables import KEY, with_key_column
from verdance.session import MICROS, run_table

DAY = "day"
COLUMNS = ("greenhouse_id", "win_start", "win_end", *STATS)


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int = 10000,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan. Without a partition column the whole table comes
    through one task; name one (``win_start``) with its bounds for large tables."""
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for k, v in (("driver", driver), ("user", user), ("password", password)):
        if v is not None:
            out[k] = v
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partition column needs lower, upper and partitions")
        out |= {
            "partitionColumn": partition_column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return out


def window_table(df: DataFrame) -> DataFrame:
    """Standard column order; a legacy table without key gets a null one."""
    return with_key_column(df).select(*COLUMNS)


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return window_table(spark.read.format("jdbc").options(**jdbc_options(**options)).load())


def read_parquet(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """A stored window table, from ``since`` on: whole days are skipped where the table
    is kept by day, row groups by the start column."""
    df = spark.read.parquet(path)
    if since is not None:
        start = F.lit(since).cast("timestamp")
        df = df.where(F.col("win_start") >= start)
        df = df.where(F.col(DAY) >= F.to_date(start)) if DAY in df.columns else df
    return window_table(df)


@contextlib.contextmanager
def _micros(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(MICROS)
    spark.conf.set(MICROS, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(MICROS, before)


def store(windows: DataFrame, path: str) -> DataFrame:
    """Writes a window table and returns it as read back: what several reports, or
    several steps of one, read is computed once, and their filters reach the files. Rows
    are range-sorted by start and starts are written as microseconds, which Parquet keeps
    statistics for: a filter on time skips files and row groups."""
    with _micros(windows.sparkSession):
        ordered = window_table(windows).repartitionByRange("win_start").sortWithinPartitions("win_start", KEY)
        ordered.write.parquet(path)
    return windows.sparkSession.read.schema(WINDOW_STATS).parquet(path)


def store_bucketed(
    windows: DataFrame, path: str, buckets: int | None = None, by: tuple[str, ...] = ("greenhouse", "win_start"), name: str | None = None
) -> DataFrame:
    """Writes a table bucketed and sorted by ``by``, one file per bucket, and returns it as
    read back. Tables with the same ``by`` and number of buckets (the session's shuffle
    partitions if not given) are aligned, grouped or joined on these columns where they lie:
    the shuffle is paid once, when written, not by each comparison. Give labelled tables,
    as alignment groups by label.

    Unlike ``store`` this does not skip files by time. A window's repeats lie in one bucket.
    Without a ``name`` the table is for this run only, see ``session.remove_run_dirs``.
    """
    spark = windows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or run_table(spark)
    with _micros(spark):
        dealt = windows.repartition(buckets, *by)
        dealt.write.format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    # without the table's name on its columns: a union tells the two sides' layouts apart by it
    return spark.table(name).toDF(*windows.columns)
