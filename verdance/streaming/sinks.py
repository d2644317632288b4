"""Stream sinks and query builders.

Builders return the configured ``DataStreamWriter``; the caller starts it. Errors of
a sink end the query, which resumes from its checkpoint (N8).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from verdance.sources.tables import DAY

#: Takes a micro-batch and its number.
Write = Callable[[DataFrame, int], None]

#: How often to look whether a query has ended.
POLL_SECONDS = 0.2


def as_message(df: DataFrame, key: str | None = None) -> DataFrame:
    """K7: each row as one JSON text in ``value``."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def to_topics(messages: DataFrame, *topics: str) -> DataFrame:
    """K9: each message once per topic, in the column the Kafka sink routes by."""
    return messages.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in topics])))


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": servers}
    return out if topic is None else out | {"topic": topic}


def _timed(w: DataStreamWriter, seconds: int | None) -> DataStreamWriter:
    """Periodic trigger, or everything available once and stop."""
    return w.trigger(availableNow=True) if seconds is None else w.trigger(processingTime=f"{seconds} seconds")


def feed_writer(
    feed: DataFrame, servers: str, topic: str, checkpoint: str, name: str, every: int | None = 5
) -> DataStreamWriter:
    """K1, K2: the feed to Kafka in update mode. Needs the Kafka connector."""
    w = as_message(feed, "greenhouse_id").writeStream.format("kafka").options(**kafka_sink_options(servers, topic))
    w = w.outputMode("update").queryName(name).option("checkpointLocation", checkpoint)
    return _timed(w, every)


def table_writer(
    windows: DataFrame, path: str, checkpoint: str, name: str, every: int | None = 10, by_day: bool = False
) -> DataStreamWriter:
    """K3 on files: closed windows appended exactly once; the file sink's log and the
    checkpoint together skip a batch that was already committed (W7, W9, W10).
    ``by_day`` keeps each day in its own folder, which ``tables.read_parquet`` prunes by."""
    if by_day:
        windows = windows.withColumn(DAY, F.to_date("win_start"))
    w = windows.writeStream.format("parquet").option("path", path).outputMode("append")
    w = w.partitionBy(DAY) if by_day else w
    return _timed(w.queryName(name).option("checkpointLocation", checkpoint), every)


def batch_writer(
    windows: DataFrame,
    write: Write,
    checkpoint: str,
    name: str,
    mode: str = "append",
    every: int | None = 10,
) -> DataStreamWriter:
    """K3, K4: each micro-batch through ``write(batch, batch_id)``."""
    w = windows.writeStream.outputMode(mode).queryName(name).foreachBatch(write)
    return _timed(w.option("checkpointLocation", checkpoint), every)


class BatchFolders:
    """Writes each micro-batch to its own folder, replacing it if the batch is retried,
    so a repeated batch leaves no repeated rows. ``files`` spreads a batch over that
    many files where one per state partition would be too many."""

    def __init__(self, path: str, files: int | None = None):
        self.path, self.files = path, files

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch if self.files is None else batch.repartition(self.files)
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


class JdbcAppend:
    """K3, K4: appends each micro-batch to a JDBC table. A batch retried after a crash
    may repeat rows; readers take repeats as one window (A4). Spark retries a failed
    insert task itself, each in its own transaction."""

    def __init__(self, url: str, table: str, batch_size: int = 1000, **properties: str):
        self.url, self.table = url, table
        self.properties = {**properties, "batchsize": str(batch_size)}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").jdbc(url=self.url, table=self.table, properties=self.properties)


def last_update(updates: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Final value of each key of an update-mode stream stored by ``BatchFolders``: a
    batch holds a key once, so the newest batch's row is the value."""
    return updates.groupBy(*keys).agg(*[F.max_by(m, "batch_id").alias(m) for m in metrics])


def start_all(*writers: DataStreamWriter) -> list[StreamingQuery]:
    """K8: several independent queries, each with its own checkpoint and state."""
    return [w.start() for w in writers]


def run_until_any_ends(spark: SparkSession, *writers: DataStreamWriter, timeout: int | None = None) -> bool | None:
    """Start all, wait for the first to end, then stop the others. True if one has
    ended before the timeout; the failure of one that ended by itself is raised. Watches
    the queries it started, whatever session they run in and whatever ended earlier."""
    queries = start_all(*writers)
    until = None if timeout is None else time.monotonic() + timeout
    ended: list[StreamingQuery] = []
    try:
        while not ended and (until is None or time.monotonic() < until):
            time.sleep(POLL_SECONDS)
            ended = [q for q in queries if not q.isActive]
    finally:
        for q in queries:
            q.stop()
    for q in ended:
        if q.exception() is not None:
            raise q.exception()
    return bool(ended)
