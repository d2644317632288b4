"""Replays: a table as a stream of files that come in a given order, out of order in event
time where the caller deals them so, and supervised runs of what reads them (W3-W6, W8-W10)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from verdance.sources.readings import parquet_stream
from verdance.streaming.sinks import Write

#: Modification time of the first file, and how much later each next one is.
FIRST_MS, STEP_MS = 1_700_000_000_000, 1000


def stage(rows: DataFrame, path: str, batch: str = "batch") -> list[int]:
    """Writes one file per value of ``batch`` (a whole number) below ``path``, with modification
    times in that order: the order in which a file stream takes them. A batch is one file, written
    by one task, so the caller bounds its rows. Returns the batches."""
    rows.repartition(batch).write.partitionBy(batch).parquet(path)
    spark = rows.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbers = {}
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith(f"{batch}="):
            numbers[int(name.partition("=")[2])] = entry.getPath()
    for place, number in enumerate(sorted(numbers)):
        for file in fs.listStatus(numbers[number]):
            fs.setTimes(file.getPath(), FIRST_MS + place * STEP_MS, -1)
    return sorted(numbers)


def staged_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """The staged files as a stream, ``max_files`` of them per micro-batch."""
    return parquet_stream(spark, f"{path}/*", schema, max_files)


def batch_counts(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch, rows read, late groups) of each micro-batch that had rows. A late group is a key
    and window whose rows the watermark refused; a stateful operator counts those after rows of
    one group were combined."""
    return [
        (p["batchId"], p["numInputRows"], sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]))
        for p in query.recentProgress
        if p["numInputRows"]
    ]


def run_with_restarts(build: Callable[[], DataStreamWriter], restarts: int) -> StreamingQuery:
    """Runs a query to its end, building and starting it again from its checkpoint when it
    fails, at most ``restarts`` times; then the failure is raised."""
    while True:
        query = build().start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if not restarts:
                raise
            restarts -= 1


class Interrupted:
    """A sink that breaks down once in each of some micro-batches: ``before`` their write, or
    ``after`` it, when the rows are there but the batch is not committed."""

    def __init__(self, write: Write, before: tuple[int, ...] = (), after: tuple[int, ...] = ()):
        self.write, self.before, self.after = write, set(before), set(after)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id in self.before:
            self.before.remove(batch_id)
            raise RuntimeError(f"broken before batch {batch_id}")
        self.write(batch, batch_id)
        if batch_id in self.after:
            self.after.remove(batch_id)
            raise RuntimeError(f"broken after batch {batch_id}")


def repeated(write: Write, batches: tuple[int, ...]) -> Write:
    """A sink that gets some micro-batches twice."""

    def both(batch: DataFrame, batch_id: int) -> None:
        for _ in range(1 + (batch_id in batches)):
            write(batch, batch_id)

    return both
