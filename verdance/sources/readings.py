"""Readings: stream and file sources, lenient and strict parsing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdance.functions.values import HUGE, epoch_ms
from verdance.model import DEFAULT_KEY, FEED, METRICS, READING, READING_TEXT

TIME = "event_time"


@dataclass(frozen=True)
class KafkaTopic:
    """Options of a Kafka subscription. Offsets live in the query's checkpoint;
    ``group`` only names the consumer group for the broker's own bookkeeping."""

    servers: str
    topic: str
    starting: str = "latest"
    max_offsets: int | None = None
    group: str | None = None

    def options(self) -> dict[str, str]:
        out = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
        }
        if self.max_offsets is not None:
            out["maxOffsetsPerTrigger"] = str(self.max_offsets)
        if self.group is not None:
            out["kafka.group.id"] = self.group
        return out

    def stream(self, spark: SparkSession) -> DataFrame:
        """Needs the Kafka connector on the class path."""
        return spark.readStream.format("kafka").options(**self.options()).load()


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One JSON message per line of files that keep arriving under ``path``."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def parquet_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def _message() -> Column:
    return F.col("value").cast("string")


def _fields(messages: DataFrame, schema: T.StructType, keep: tuple[str, ...]) -> DataFrame:
    """Each message's fields as columns. Through a generator, since a filter above
    would be pushed below a plain projection and parse the text once per field."""
    parsed = F.inline(F.array(F.from_json(_message(), schema)))
    return messages.select(*keep, parsed)


def parse(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Permissive parse; what cannot be read is null. Numbers are
    doubles throughout, single precision would shift the means."""
    return _fields(messages, READING, keep).withColumn(TIME, epoch_ms(F.col("timestamp")))


def parse_strict(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse that judges each message. Adds ``reject``: null for a good reading,
    else what is wrong with it. Numbers may come as text, but must be finite and below
    HUGE; a missing or empty key becomes the default key."""
    d = _fields(messages, READING_TEXT, (*keep, _message().alias("value")))
    number = {m: F.col(m).try_cast("double") for m in METRICS}
    ms = F.coalesce(F.col("timestamp").try_cast("long"), F.col("timestamp").try_cast("double").try_cast("long"))
    bad = F.when(F.coalesce(*READING_TEXT.fieldNames()).isNull(), F.lit("no reading"))
    for m in METRICS:
        bad = bad.when(number[m].isNull(), F.lit(f"bad {m}"))
        bad = bad.when(~(F.abs(number[m]) < HUGE), F.lit(f"{m} out of range"))
    bad = bad.when(ms.isNull(), F.lit("bad timestamp"))
    return d.select(
        *keep,
        F.coalesce(F.nullif("greenhouse_id", F.lit("")), F.lit(DEFAULT_KEY)).alias("greenhouse_id"),
        *[number[m].alias(m) for m in METRICS],
        ms.alias("timestamp"),
        epoch_ms(ms).alias(TIME),
        bad.alias("reject"),
        "value",
    )


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject").isNull()).drop("reject", "value")


def rejected(judged: DataFrame) -> DataFrame:
    """What the strict parse refused, with the reason and the original text."""
    return judged.where(F.col("reject").isNotNull()).select("reject", "value")


def on_arrival(readings: DataFrame) -> DataFrame:
    """Event time replaced by processing time, one value per micro-batch."""
    return readings.withColumn(TIME, F.current_timestamp())


def parse_feed(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the result feed."""
    return _fields(messages, FEED, keep)
