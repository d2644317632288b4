"""Readings, window tables and questions derived from the whole test tables.

Readings come from ``events``: metrics are integer hundredths, so every sum is exact
and the results do not depend on shuffle order. Windows are one hour long, which
gives several readings per window; the other time limits are scaled alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions import labels
from verdance.model import LABELS, AlarmSpec, WindowSpec
from verdance.operators import windowing
from verdance.plans.compare import load_windows
from verdance.session import run_dir
from verdance.sources.tables import store, store_bucketed

HOUR = 3600
SPEC = WindowSpec(seconds=HOUR, slide_seconds=HOUR, scale=100)
DOUBLES = WindowSpec(seconds=HOUR, slide_seconds=HOUR)
SLIDING = WindowSpec(seconds=2 * HOUR, slide_seconds=HOUR, scale=100)
ALARM = AlarmSpec(lookback_seconds=12 * HOUR, bucket_seconds=96 * HOUR)
ALIVE_SECONDS = 24 * HOUR
AUDIT_MINUTES = 360 * 60
#: Replays: days in a micro-batch, what is still in time, and windows that wait for everything.
SPAN_DAYS = 6
LATE = WindowSpec(seconds=HOUR, slide_seconds=HOUR, scale=100, watermark="2 days")
PATIENT = WindowSpec(seconds=HOUR, slide_seconds=HOUR, scale=100, watermark="400 days")
ARRIVAL = WindowSpec(seconds=5, scale=100)


# declared, so that reading starts no job to look at file footers
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def as_readings(ev: DataFrame) -> DataFrame:
    """Works on a batch and on a stream of events."""
    i = F.col("event_id")
    return ev.select(
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("gh_0"), (F.col("user_id") % 3 + 1).cast("string")).alias("greenhouse_id"),
        (2200 + (i * 37) % 1400).alias("air_temp"),
        (2000 + (i * 53) % 5000).alias("air_humidity"),
        (1000 + (i * 71) % 5000).alias("soil_humidity"),
        (200000 + (i * 7919) % 9800000).alias("light"),
    )


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the micro-batch they come in: that of their days, or one or two later."""
    i = F.col("event_id")
    late = F.when(i % 11 == 5, 2).when(i % 7 == 3, 1).otherwise(0)
    span = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / SPAN_DAYS)
    return events(spark, sf_dir).withColumn("batch", (span + late).cast("int"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(events(spark, sf_dir))


def left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain means (A1)."""
    return windowing.tumbling_avg_max(readings(spark, sf_dir), SPEC)


def right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed means (A3)."""
    return windowing.tumbling_trimmed_mean(readings(spark, sf_dir), SPEC)


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain means of an engine that was down every fourth hour: it read everything, but
    lacks windows that ``right`` has."""
    return left(spark, sf_dir).where(F.hour("win_start") % 4 != 1)


def cool(windows: DataFrame, *keys: str) -> DataFrame:
    """Window table in which some greenhouses are twenty degrees colder, none without keys
    named but all."""
    colder = F.lit(True) if not keys else F.col("greenhouse_id").isin(*keys)
    return windows.withColumn("avg_temp", F.when(colder, F.col("avg_temp") - 20).otherwise(F.col("avg_temp")))


def outlier_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in degrees and percent as JSON messages; a temperature now and then is a
    large number or not finite."""
    i, temp = F.col("event_id"), F.col("air_temp") / 100.0
    kind = F.when(i % 331 == 7, (i / 331).cast("long") % 3)
    spiked = F.when(kind == 0, F.lit(1e17)).when(kind == 1, F.lit(1e300)).when(kind == 2, F.lit(float("inf"))).otherwise(temp)
    rest = [(F.col(m) / 100.0).alias(m) for m in ("air_humidity", "soil_humidity", "light")]
    body = F.struct("greenhouse_id", spiked.alias("air_temp"), *rest, F.unix_millis("event_time").alias("timestamp"))
    return readings(spark, sf_dir).select("event_id", F.to_json(body).alias("value"))


def stored(windows: DataFrame, name: str) -> DataFrame:
    """The window table written below the shared folder, for queries that read it
    several times."""
    return store(windows, run_dir(windows.sparkSession, name))


def bucketed(rows: DataFrame, name: str) -> DataFrame:
    """A labelled table stored so that comparisons need not shuffle it."""
    return store_bucketed(rows, run_dir(rows.sparkSession, name))


def labelled(windows: DataFrame) -> DataFrame:
    return load_windows(windows, True, window_seconds=HOUR)


def unkeyed(windows: DataFrame, *keys: str) -> DataFrame:
    """Window table in which the rows of some greenhouses lost their key."""
    kept = F.when(~F.col("greenhouse_id").isin(*keys), F.col("greenhouse_id"))
    w = windows.withColumn("greenhouse_id", kept)
    return w.withColumn("greenhouse", labels.normalized(F.col("greenhouse_id")))


def repeated(windows: DataFrame) -> DataFrame:
    """Window table in which windows of odd hours are stored twice, one degree apart."""
    copies = F.sequence(F.lit(0), F.hour("win_start") % 2)
    return windows.withColumn("copy", F.explode(copies)).select(
        "greenhouse_id",
        "win_start",
        "win_end",
        (F.col("avg_temp") + F.col("copy")).alias("avg_temp"),
        "avg_humidity",
        "avg_soil_humidity",
        "max_light",
    )


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Stands for the current time: the newest reading."""
    return readings(spark, sf_dir).agg(F.max("event_time")).scalar()


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as JSON messages, those of three event types flawed: ``signup`` has no
    key, ``error`` an empty key, and ``purchase`` text for the temperature."""
    kind = F.col("event_type")
    key = F.when(kind == "error", "").when(kind != "signup", F.col("greenhouse_id")).alias("greenhouse_id")
    rest = ("air_humidity", "soil_humidity", "light", F.unix_millis("event_time").alias("timestamp"))
    sound = F.to_json(F.struct(key, "air_temp", *rest))
    flawed = F.to_json(F.struct(key, F.lit("n/a").alias("air_temp"), *rest))
    body = F.when(kind == "purchase", flawed).otherwise(sound)
    return readings(spark, sf_dir).select("event_id", body.alias("value"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question per event, worded by its type, and every conversation text."""
    user = F.col("user_id")

    def name(i: Column) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in LABELS]), (i % 3 + 1).cast("int"))

    general = (
        F.when(user % 4 == 0, "哪个大棚告警最多")
        .when(user % 4 == 1, "Spark 和 Flink 差异")
        .when(user % 4 == 2, "各大棚平均温度排行")
        .otherwise("你好")
    )
    asked = (
        F.when(F.col("event_type") == "error", "为什么会高温")
        .when(F.col("event_type") == "view", F.concat(name(user), F.lit("最近温度多少")))
        .when(F.col("event_type") == "click", F.concat(name(user), F.lit("与"), name(user + 1)))
        .when(F.col("event_type") == "purchase", F.concat(name(user), F.lit("有多少次告警")))
        .otherwise(general)
    )
    from_events = events(spark, sf_dir).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("q_id"), asked.alias("q")
    )
    talks = spark.read.schema(CONVERSATIONS).parquet(f"{sf_dir}/conversations.parquet").select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("q_id"),
        F.col("text").alias("q"),
    )
    return from_events.unionByName(talks)
