"""Window tables with one row per key on plain files, and ledgers of micro-batches.

``KeyedTable`` is an upsert by (greenhouse, start) that may be repeated and may break down
anywhere; ``ArrivalLedger`` remembers when a micro-batch first came, so arrival-time windows are
the same after a retry.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.model import FEED_METRICS, METRICS, STAT_OF, STATS, WindowSpec
from verdance.operators.windowing import KEY, TIME, as_feed
from verdance.sources.tables import DAY
from verdance.streaming.sinks import Write, as_message

START, BATCH = "win_start", "batch_id"
_ROWS = f"{KEY} string, {START} timestamp, win_end timestamp, " + ", ".join(f"{s} double" for s in STATS)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class KeyedTable:
    """One row per (greenhouse, start), the one of the newest micro-batch.

    A micro-batch rewrites the days it touches into a folder of its own,
    ``data/batch_id=N/day=D``, and then notes these days in ``ledger/batch_id=N``. Readers take
    each day from the newest noted batch. So days without new rows are neither read nor written,
    a batch that breaks down halfway is not seen, and one that is repeated replaces itself: it is
    merged with the batches before it only.
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # kept as files first: the batch is needed twice, and computing it runs the state
        came = f"{self.path}/incoming/{BATCH}={batch_id}"
        batch.select(KEY, START, "win_end", *STATS).withColumn(DAY, F.to_date(START)).write.mode("overwrite").parquet(came)
        new = spark.read.schema(f"{_ROWS}, {DAY} date").parquet(came).withColumn("_at", F.lit(batch_id).cast("long"))
        days = new.select(DAY).distinct()
        old = self._versions(spark, batch_id)
        if old is not None:
            new = new.unionByName(old.withColumnRenamed(BATCH, "_at").join(days, DAY, "left_semi"))
        whole = new.groupBy(KEY, START, DAY).agg(*[F.max_by(c, "_at").alias(c) for c in ("win_end", *STATS)])
        whole.write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/data/{BATCH}={batch_id}")
        days.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/{BATCH}={batch_id}")
        _remove(spark, came)

    def _newest(self, spark: SparkSession, before: int | None) -> DataFrame:
        noted = spark.read.schema(f"{DAY} date, {BATCH} long").parquet(f"{self.path}/ledger")
        noted = noted if before is None else noted.where(F.col(BATCH) < before)
        return noted.groupBy(DAY).agg(F.max(BATCH).alias(BATCH))

    def _versions(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        if not _exists(spark, f"{self.path}/ledger"):
            return None
        rows = spark.read.schema(f"{_ROWS}, {BATCH} long, {DAY} date").parquet(f"{self.path}/data")
        return rows.join(self._newest(spark, before), [DAY, BATCH], "left_semi")

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the last noted micro-batch; by day and batch, whole folders are skipped."""
        found = self._versions(spark)
        found = spark.createDataFrame([], f"{_ROWS}, {BATCH} long, {DAY} date") if found is None else found
        return found.select(KEY, START, "win_end", *STATS)

    def vacuum(self, spark: SparkSession) -> int:
        """Deletes folders of days that a later micro-batch has rewritten. For when nobody reads
        older versions; returns their number."""
        if not _exists(spark, f"{self.path}/ledger"):
            return 0
        noted = spark.read.schema(f"{DAY} date, {BATCH} long").parquet(f"{self.path}/ledger")
        past = noted.join(self._newest(spark, None), [DAY, BATCH], "left_anti").collect()
        gone = [p for r in past if _exists(spark, p := f"{self.path}/data/{BATCH}={r[BATCH]}/{DAY}={r[DAY]}")]
        for path in gone:
            _remove(spark, path)
        return len(gone)


class Fanout:
    """K8: one micro-batch to several sinks. It is computed once and held meanwhile; a retry
    repeats it to all of them, so each has to take repeats."""

    def __init__(self, *writes: Write):
        self.writes = writes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in self.writes:
                write(batch, batch_id)
        finally:
            batch.unpersist()


class FeedFolders:
    """K1 on files: windows as messages of the result feed, a folder per micro-batch, replaced
    if the batch is retried."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        as_message(as_feed(batch)).write.mode("overwrite").text(f"{self.path}/{BATCH}={batch_id}")


def feed_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The feed read back as a stream, with the number of the micro-batch that sent a message."""
    reader = spark.readStream.format("text")
    reader = reader if max_files is None else reader.option("maxFilesPerTrigger", str(max_files))
    sent = F.regexp_extract(F.col("_metadata.file_path"), rf"{BATCH}=(\d+)", 1).cast("long")
    return reader.load(f"{path}/*").select("value", sent.alias("sent"))


class ArrivalLedger:
    """When each micro-batch first came. Noted before its rows are used and never
    changed, so a retried batch keeps its time."""

    def __init__(self, path: str, clock: Callable[[int], dt.datetime] | None = None):
        self.path, self.clock = path, clock

    def stamp(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """One row, ``event_time``."""
        now = F.current_timestamp() if self.clock is None else F.lit(self.clock(batch_id)).cast("timestamp")
        noted = f"{self.path}/{BATCH}={batch_id}"
        if not _exists(spark, f"{noted}/_SUCCESS"):
            spark.range(1).select(now.alias(TIME)).write.mode("overwrite").parquet(noted)
        return spark.read.schema(f"{TIME} timestamp").parquet(noted)


class ArrivalWindows:
    """Means per arrival-time window (P3, A1). All rows of a micro-batch came at once, so it adds
    one row of sums per greenhouse, in a folder that a retry replaces; reading adds those up."""

    def __init__(self, path: str, ledger: ArrivalLedger, spec: WindowSpec = WindowSpec()):
        self.path, self.ledger, self.spec = path, ledger, spec

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        sums = [a for m in METRICS[:3] for a in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
        came = F.lit(self.ledger.stamp(batch.sparkSession, batch_id).first()[TIME])
        start = F.window(came, self.spec.size, startTime=self.spec.offset)["start"]
        rows = batch.groupBy(KEY).agg(F.count("*").alias("n"), F.max("light").alias("light"), *sums)
        rows.withColumn(TIME, came).withColumn(START, start).drop(TIME).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        scale = F.lit(float(self.spec.scale))
        means = [(F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")) / scale).alias(STAT_OF[m]) for m in METRICS[:3]]
        end = F.col(START) + F.make_interval(secs=F.lit(self.spec.seconds))
        whole = spark.read.parquet(self.path).groupBy(KEY, START).agg(*means, (F.max("light") / scale).alias(STAT_OF["light"]), F.sum("n").alias("n"))
        return whole.select(KEY, START, end.alias("win_end"), *STATS, "n")


def newest_messages(messages: DataFrame) -> DataFrame:
    """The last message of each greenhouse and window end."""
    return messages.groupBy(KEY, "ts").agg(*[F.max_by(m, "sent").alias(m) for m in FEED_METRICS])
