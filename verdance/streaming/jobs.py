"""The three streaming jobs over any stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from verdance.model import WindowSpec
from verdance.operators import windowing as w
from verdance.sources.readings import on_arrival
from verdance.streaming import sinks


def event_time_job(
    readings: DataFrame, write, checkpoint: str, spec: WindowSpec = WindowSpec(), every: int | None = 10
) -> DataStreamWriter:
    """Trimmed means per event-time window, each window once, after the watermark
    passed its end; later readings are dropped."""
    return sinks.batch_writer(w.tumbling_trimmed_mean(readings, spec), write, checkpoint, "event_time", every=every)


def arrival_time_jobs(
    readings: DataFrame,
    write,
    feed,
    checkpoint: str,
    spec: WindowSpec = WindowSpec(),
    table_every: int | None = 10,
    feed_every: int | None = 5,
) -> tuple[DataStreamWriter, DataStreamWriter]:
    """K8: means per arrival-time window, to a table when closed and to a feed on
    every update. ``feed(frame, checkpoint, every)`` makes the feed's writer."""
    windows = w.tumbling_avg_max(on_arrival(readings), spec)
    table = sinks.batch_writer(windows, write, f"{checkpoint}/table", "arrival_table", every=table_every)
    return table, feed(w.as_feed(windows), f"{checkpoint}/feed", feed_every)


def sliding_job(
    readings: DataFrame, feed, checkpoint: str, spec: WindowSpec = WindowSpec(), every: int | None = None
) -> DataStreamWriter:
    """Sliding means in update mode; the watermark bounds the state."""
    return feed(w.sliding_avg(readings, spec), checkpoint, every)
