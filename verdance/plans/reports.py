"""Rankings, summaries and exports.

``digits`` rounds the means, which are sums over many windows in no fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.functions import labels
from verdance.functions.values import time_text
from verdance.model import EXPORT_HEADER, LABELS, STATS
from verdance.operators.tables import keyed_only, labelled, latest, with_key_column

HOT = 30.0


def _mean(c: str, digits: int) -> Column:
    return F.round(F.avg(c), digits)


def hot_windows(windows: DataFrame, hot_above: float = HOT) -> DataFrame:
    """L1"""
    return windows.where(F.col("avg_temp") > hot_above)


def alarm_count(windows: DataFrame, greenhouse: str | None = None, hot_above: float = HOT, digits: int = 4) -> DataFrame:
    """Number, mean and maximum temperature of hot windows, of one greenhouse
    (label or key, L2, F4) or of all."""
    hot = hot_windows(windows, hot_above)
    if greenhouse is not None:
        hot = hot.where(F.col("greenhouse_id") == labels.key_of(F.lit(greenhouse)))
    return hot.agg(
        F.count("*").alias("n"),
        _mean("avg_temp", digits).alias("mean_temp"),
        F.round(F.max("avg_temp"), digits).alias("max_temp"),
    )


def alarm_top(windows: DataFrame, hot_above: float = HOT) -> DataFrame:
    """Hot windows per key, most first."""
    return (
        keyed_only(hot_windows(windows, hot_above))
        .groupBy("greenhouse_id")
        .agg(F.count("*").alias("n"))
        .select(labels.normalized(F.col("greenhouse_id")).alias("greenhouse"), "greenhouse_id", "n")
        .orderBy(F.desc("n"), "greenhouse_id")
    )


def alarm_top_synthetic(windows: DataFrame, hot_above: float = HOT, window_seconds: int = 5) -> DataFrame:
    """Hot windows per synthetic label, most first."""
    return (
        labelled(hot_windows(windows, hot_above), False, window_seconds)
        .groupBy("greenhouse")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "greenhouse")
    )


def gh_rank(windows: DataFrame, digits: int = 4) -> DataFrame:
    """Mean environment per key, warmest first."""
    return (
        keyed_only(windows)
        .groupBy("greenhouse_id")
        .agg(
            _mean("avg_temp", digits).alias("mean_temp"),
            _mean("avg_humidity", digits).alias("mean_humidity"),
            _mean("max_light", digits).alias("mean_max_light"),
            F.max("win_start").alias("last_start"),
        )
        .select(labels.normalized(F.col("greenhouse_id")).alias("greenhouse"), "*")
        .orderBy(F.desc("mean_temp"), "greenhouse_id")
    )


def _label_rows(df: DataFrame) -> DataFrame:
    """The three labels in fixed order, made from a literal."""
    rows = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(x).alias("greenhouse")) for i, x in enumerate(LABELS)])
    return df.sparkSession.range(1).select(F.inline(rows))


def gh_rank_synthetic(
    windows: DataFrame, last_n: int | None = None, window_seconds: int = 5, digits: int = 4
) -> DataFrame:
    """A10: mean environment per synthetic label over all window starts, or the newest: mean
    per start, then mean of those. Every label shows, with nulls if it has no data."""
    means = ("avg_temp", "avg_humidity", "max_light")
    starts = windows.groupBy("win_start").agg(*[F.avg(m).alias(m) for m in means])
    if last_n is not None:
        starts = starts.orderBy(F.desc("win_start")).limit(last_n)
    per_label = (
        starts.withColumn("greenhouse", labels.synthetic(F.col("win_start"), window_seconds))
        .groupBy("greenhouse")
        .agg(
            _mean("avg_temp", digits).alias("mean_temp"),
            _mean("avg_humidity", digits).alias("mean_humidity"),
            _mean("max_light", digits).alias("mean_max_light"),
        )
    )
    shown = _label_rows(windows).join(per_label, "greenhouse", "left")
    return shown.select("ord", "greenhouse", "mean_temp", "mean_humidity", "mean_max_light").orderBy("ord")


def gh_latest(windows: DataFrame, greenhouse: str | None = None) -> DataFrame:
    """V3: newest window of each greenhouse, or of one; of repeats the one with the largest
    values. ``windows`` is labelled, by key or by time. The newest starts are found first, in
    fixed-width buffers; only rows of these starts are ranked."""
    if greenhouse is not None:
        windows = windows.where(F.col("greenhouse") == greenhouse)
    rows = windows.where(F.col("greenhouse").isNotNull()).select("greenhouse", "win_start", *STATS)
    last = rows.groupBy("greenhouse").agg(F.max("win_start").alias("win_start"))
    largest = Window.partitionBy("greenhouse").orderBy(*[F.desc(s) for s in STATS])
    newest = rows.join(last, ["greenhouse", "win_start"]).withColumn("_place", F.row_number().over(largest))
    return newest.where("_place = 1").drop("_place")


def gh_means(windows: DataFrame, names: tuple[str, ...] = LABELS, last_n: int | None = None, digits: int = 4) -> DataFrame:
    """Mean environment of the named greenhouses (L7), over all rows or the newest."""
    rows = windows if last_n is None else latest(windows, last_n)
    return (
        rows.where(F.col("greenhouse").isin(*names))
        .groupBy("greenhouse")
        .agg(
            _mean("avg_temp", digits).alias("mean_temp"),
            _mean("avg_humidity", digits).alias("mean_humidity"),
            _mean("max_light", digits).alias("mean_max_light"),
        )
    )


def gh_compare(windows: DataFrame, first: str, second: str, last_n: int | None = None, digits: int = 4) -> DataFrame:
    """Two labelled greenhouses side by side, one row: three means each, the
    temperature difference, and which is warmer. One pass, conditional aggregates."""
    rows = windows if last_n is None else latest(windows, last_n)
    rows = rows.where(F.col("greenhouse").isin(first, second))
    aggs = []
    for i, name in enumerate((first, second), 1):
        for m, out in (("avg_temp", "temp"), ("avg_humidity", "humidity"), ("max_light", "light")):
            aggs.append(F.round(F.avg(F.when(F.col("greenhouse") == name, F.col(m))), digits).alias(f"{out}_{i}"))
    d = F.round(F.col("temp_1") - F.col("temp_2"), digits)
    return rows.agg(*aggs).select(
        F.lit(first).alias("gh1"),
        F.lit(second).alias("gh2"),
        "*",
        d.alias("diff_temp"),
        F.when(d > 0, F.lit("高")).when(d <= 0, F.lit("低")).alias("verdict"),
    )


def window_export(
    windows: DataFrame, real: bool | Column = True, newest: int | None = None, window_seconds: int = 5
) -> DataFrame:
    """K5: windows as a report table, newest first, all or the newest n: label, times as
    text, two decimals. Without n the rows are range-sorted, in no single task."""
    rows = with_key_column(windows)
    # the values break ties between repeats, so a cut is the same on every run
    rows = rows.orderBy(F.desc("win_start"), "greenhouse_id", *STATS)
    rows = rows if newest is None else rows.limit(newest)
    named = labelled(rows, real, window_seconds)
    cols = [
        F.coalesce("greenhouse", F.lit("")),
        time_text(F.col("win_start")),
        time_text(F.col("win_end")),
        *[F.round(s, 2) for s in STATS],
    ]
    return named.select(*[c.alias(h) for c, h in zip(cols, EXPORT_HEADER)])
