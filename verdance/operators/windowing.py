"""Window statistics (A1-A3, W1, W2, P4, P5, P7): batch or stream in, one row per window out.

Every aggregate here combines on the map side, so a key or window that holds a
large share of the readings reaches the shuffle as a handful of partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdance.functions.values import trimmed_mean
from verdance.model import FEED_METRICS, METRICS, STAT_OF, STATS, WindowSpec

KEY, TIME = "greenhouse_id", "event_time"


def with_watermark(readings: DataFrame, spec: WindowSpec) -> DataFrame:
    """Bound the lateness of a stream; a batch is returned as it is."""
    return readings.withWatermark(TIME, spec.watermark) if readings.isStreaming else readings


def _scaled(c: Column, spec: WindowSpec) -> Column:
    return c if spec.scale == 1 else c / F.lit(float(spec.scale))


def _per_window(readings: DataFrame, spec: WindowSpec, aggs: list[Column]) -> DataFrame:
    """Aggregates per greenhouse and tumbling window, in table order.

    A stream must group by the window struct, which carries the watermark. A batch
    groups by its start alone: a shorter key to hash and shuffle, the end follows.
    """
    window = F.window(TIME, spec.size, startTime=spec.offset)
    if readings.isStreaming:
        grouped = with_watermark(readings, spec).groupBy(KEY, window).agg(*aggs)
        start, end = F.col("window.start"), F.col("window.end")
    else:
        grouped = readings.withColumn("win_start", window["start"]).groupBy(KEY, "win_start").agg(*aggs)
        start = F.col("win_start")
        end = start + F.make_interval(secs=F.lit(spec.seconds))
    return grouped.select(KEY, start.alias("win_start"), end.alias("win_end"), *STATS)


def tumbling_avg_max(readings: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """A1: mean of three metrics and maximum light per greenhouse and window."""
    aggs = [_scaled(F.avg(m), spec).alias(STAT_OF[m]) for m in METRICS[:3]]
    aggs.append(_scaled(F.max("light"), spec).alias(STAT_OF["light"]))
    return _per_window(readings, spec, aggs)


def tumbling_trimmed_mean(
    readings: DataFrame, spec: WindowSpec = WindowSpec(), digits: int = 4
) -> DataFrame:
    """A3: trimmed mean of three metrics and maximum light, rounded."""
    whole = {f.name: isinstance(f.dataType, T.IntegralType) for f in readings.schema}
    aggs = [F.round(_scaled(trimmed_mean(F.col(m), whole[m]), spec), digits).alias(STAT_OF[m]) for m in METRICS[:3]]
    aggs.append(F.round(_scaled(F.max("light"), spec).cast("double"), digits).alias(STAT_OF["light"]))
    return _per_window(readings, spec, aggs)


def sliding_avg(readings: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """A2: mean of all four metrics over sliding windows, in feed form (P5).

    A batch whose slide divides the window is first reduced to one row per slide,
    and only those rows are copied into the windows that cover them; copying each
    reading (5 s / 1 s: five times) would multiply the scan's output instead. A
    stream uses the built-in sliding window, which keeps it to one stateful step.
    """
    if readings.isStreaming or spec.seconds % spec.slide_seconds:
        windowed = (
            with_watermark(readings, spec)
            .groupBy(KEY, F.window(TIME, spec.size, spec.slide, startTime=spec.offset))
            .agg(*[_scaled(F.avg(m), spec).alias(f) for m, f in zip(METRICS, FEED_METRICS)])
        )
        return windowed.select(KEY, F.col("window.end").alias("ts"), *FEED_METRICS)

    parts = [a for m in METRICS for a in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    pane = F.window(TIME, spec.slide, startTime=spec.offset)["start"]
    panes = readings.withColumn("pane", pane).groupBy(KEY, "pane").agg(*parts)
    slide = F.make_interval(secs=F.lit(spec.slide_seconds))
    last = F.col("pane") + F.make_interval(secs=F.lit(spec.seconds))
    ends = F.explode_outer(F.sequence(F.col("pane") + slide, last, slide))  # never empty
    means = [
        _scaled(F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")), spec).alias(f)
        for m, f in zip(METRICS, FEED_METRICS)
    ]
    return panes.withColumn("ts", ends).groupBy(KEY, "ts").agg(*means).select(KEY, "ts", *FEED_METRICS)


def as_feed(windows: DataFrame) -> DataFrame:
    """P5: window statistics under the feed's names. The feed's ``light_avg`` carries
    the maximum here, as its consumers expect from this producer."""
    renamed = [F.col(s).alias(f) for s, f in zip(STATS, FEED_METRICS)]
    return windows.select(KEY, F.col("win_end").alias("ts"), *renamed)
