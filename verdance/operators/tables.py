"""Reading a window table: key probe, labels, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import labels
from verdance.model import STATS

KEY = "greenhouse_id"


def with_key_column(windows: DataFrame) -> DataFrame:
    """A table without the key column gets a null one."""
    return windows if KEY in windows.columns else windows.withColumn(KEY, F.lit(None).cast("string"))


def probe_key(windows: DataFrame) -> DataFrame:
    """One row, whether the key column exists and holds two or more distinct keys.

    Two distinct values exist exactly when smallest and largest differ, so no
    distinct set is shuffled.
    """
    exists = KEY in windows.columns
    key = F.nullif(F.col(KEY), F.lit("")) if exists else F.lit(None).cast("string")
    return windows.agg(F.coalesce(F.min(key) != F.max(key), F.lit(False)).alias("multi_key")).select(
        F.lit(exists).alias("has_key"), "multi_key"
    )


def multi_key(windows: DataFrame) -> Column:
    """A13 as a scalar for use inside another query."""
    return probe_key(windows).select("multi_key").scalar()


def _flag(real: bool | Column) -> Column:
    return F.lit(real) if isinstance(real, bool) else real


def labelled(windows: DataFrame, real: bool | Column, window_seconds: int = 5) -> DataFrame:
    """``greenhouse`` label per row: from the key where the table has real keys,
    from the window's time otherwise."""
    w = with_key_column(windows)
    name = F.when(_flag(real), labels.normalized(F.col(KEY))).otherwise(
        labels.synthetic(F.col("win_start"), window_seconds)
    )
    return w.withColumn("greenhouse", name)


def keyed_only(windows: DataFrame, real: bool | Column = True) -> DataFrame:
    """L3: where keys are real, drop rows without one."""
    return with_key_column(windows).where(~_flag(real) | labels.has_key(F.col(KEY)))


def dedup_windows(windows: DataFrame, key: str = KEY) -> DataFrame:
    """A4: one row per key and window, the mean of its repeats."""
    return windows.groupBy(key, "win_start", "win_end").agg(*[F.avg(s).alias(s) for s in STATS])


def latest(windows: DataFrame, n: int | None, key: str = "greenhouse") -> DataFrame:
    """Newest n rows, key as tie-break; all without n."""
    return windows if n is None else windows.orderBy(F.desc("win_start"), F.asc(key)).limit(n)


def latest_windows(windows: DataFrame, n: int, key: str = "greenhouse") -> DataFrame:
    """T2 on distinct windows (A4): the newest n of a table that may repeat them.

    The n newest windows start no earlier than the n-th newest distinct start. That
    start is found first, from one column, so that only rows from there on are read
    in full and grouped, instead of the whole table.
    """
    starts = windows.select("win_start").distinct().orderBy(F.desc("win_start")).limit(n)
    oldest = starts.agg(F.min("win_start")).scalar()
    return latest(dedup_windows(windows.where(F.col("win_start") >= oldest), key), n, key)


def duplicate_windows(
    windows: DataFrame, as_of: Column | None = None, minutes: int = 30, newest: int | None = None
) -> DataFrame:
    """Windows stored more than once since ``as_of`` less ``minutes`` (L8),
    with the spread of their values."""
    if as_of is not None:
        windows = windows.where(F.col("win_start") >= as_of - F.make_interval(mins=F.lit(minutes)))
    found = (
        windows.groupBy("win_start", KEY)
        .agg(
            F.count("*").alias("cnt"),
            F.min("avg_temp").alias("min_temp"),
            F.max("avg_temp").alias("max_temp"),
            F.min("avg_humidity").alias("min_humidity"),
            F.max("avg_humidity").alias("max_humidity"),
        )
        .where(F.col("cnt") > 1)
    )
    ordered = found.orderBy(F.desc("win_start"), F.asc(KEY))
    return ordered if newest is None else ordered.limit(newest)


def key_counts(windows: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per key value, null included, most frequent first; all or the top n."""
    counts = with_key_column(windows).groupBy(KEY).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(KEY))
    return counts if top is None else counts.limit(top)


def key_rows(windows: DataFrame, keys: tuple[str | None, ...]) -> DataFrame:
    """Row count of each probed key value; a null probe counts the null keys.
    One pass over the table, whatever the number of probes."""
    key = F.col(KEY)
    counts = [
        F.count_if(key.isNull() if k is None else F.coalesce(key == k, F.lit(False))) for k in keys
    ]
    one = with_key_column(windows).agg(
        F.array(
            *[F.struct(F.lit(k).cast("string").alias(KEY), c.alias("n")) for k, c in zip(keys, counts)]
        ).alias("probe")
    )
    return one.select(F.inline("probe"))
