"""Parsing, source and sink options, report files."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from verdance.model import FEED
from verdance.plans import alarms, compare, reports
from verdance.operators.align import align
from verdance.sources import exports, readings, tables
from verdance.streaming import sinks

GOOD = {
    "greenhouse_id": "gh_02",
    "air_temp": 31.25,
    "air_humidity": 52.1,
    "soil_humidity": 44.0,
    "light": 4200.5,
    "timestamp": 1704067203123,
}


def messages(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")


def without(key):
    return json.dumps({k: v for k, v in GOOD.items() if k != key})


def test_strict_parse_s6(spark):
    df = messages(
        spark,
        json.dumps(GOOD),
        without("greenhouse_id"),
        json.dumps(GOOD | {"greenhouse_id": ""}),
        json.dumps(GOOD | {"air_temp": "31.25"}),
        json.dumps(GOOD | {"timestamp": "1704067203123"}),
        json.dumps(GOOD | {"air_temp": "warm"}),
        without("timestamp"),
        without("light"),
        "not json",
        "",
        None,
    )
    judged = readings.parse_strict(df, ("i",))
    good = {r["i"]: r for r in readings.accepted(judged).collect()}
    assert sorted(good) == [0, 1, 2, 3, 4]
    assert [good[i]["greenhouse_id"] for i in sorted(good)] == ["gh_02", "gh_01", "gh_01", "gh_02", "gh_02"]
    assert {r["air_temp"] for r in good.values()} == {31.25}
    assert {str(r["event_time"]) for r in good.values()} == {"2024-01-01 00:00:03.123000"}
    bad = sorted(r["reject"] for r in readings.rejected(judged).collect())
    assert bad == ["bad air_temp", "bad light", "bad timestamp", "no reading", "no reading", "no reading"]


@pytest.mark.parametrize("text", ["Infinity", "-Infinity", "NaN", "1e300", "-1e15"])
def test_strict_parse_refuses_what_is_not_a_reading_s6(spark, text):
    body = f'{{"greenhouse_id":"gh_01","air_temp":"{text}","air_humidity":1,"soil_humidity":1,"light":1,"timestamp":1}}'
    judged = readings.parse_strict(spark.createDataFrame([(body,)], "value string"))
    assert [r["reject"] for r in readings.rejected(judged).collect()] == ["air_temp out of range"]
    assert readings.accepted(judged).collect() == []


def test_lenient_parse_s4(spark):
    df = messages(spark, json.dumps(GOOD), "not json", json.dumps(GOOD | {"air_temp": "warm"}))
    got = {r["i"]: r for r in readings.parse(df, ("i",)).collect()}
    assert got[0]["air_temp"] == 31.25 and str(got[0]["event_time"]) == "2024-01-01 00:00:03.123000"
    assert got[1]["greenhouse_id"] is None and got[1]["event_time"] is None
    assert got[2]["air_temp"] is None and got[2]["light"] == 4200.5


def test_parse_binary_values(spark):
    df = messages(spark, json.dumps(GOOD)).withColumn("value", F.col("value").cast("binary"))
    assert readings.parse(df).first()["light"] == 4200.5


def test_feed_round_trip_k7_s8(spark):
    rows = [("gh_01", None, 1.5, None, 2.0, 3.0)]
    feed = spark.createDataFrame(rows, FEED).withColumn("ts", F.lit("2024-01-01 00:00:05").cast("timestamp"))
    sent = sinks.as_message(feed, "greenhouse_id")
    assert json.loads(sent.first()["value"]) == {
        "greenhouse_id": "gh_01",
        "ts": "2024-01-01T00:00:05.000Z",
        "air_temp_avg": 1.5,
        "soil_humidity_avg": 2.0,
        "light_avg": 3.0,
    }
    assert readings.parse_feed(sent).collect() == feed.collect()


def test_two_topics_k9(spark):
    got = sinks.to_topics(messages(spark, "a", "b"), "t1", "t2").select("topic", "value").collect()
    assert sorted(map(tuple, got)) == [("t1", "a"), ("t1", "b"), ("t2", "a"), ("t2", "b")]


def test_kafka_options_s1_s2_s3_k1():
    topic = readings.KafkaTopic("h:9092", "in", max_offsets=300, group="g")
    assert topic.options() == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "in",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "300",
        "kafka.group.id": "g",
    }
    assert set(readings.KafkaTopic("h:9092", "in").options()) == {"kafka.bootstrap.servers", "subscribe", "startingOffsets"}
    assert sinks.kafka_sink_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}


def test_jdbc_options_s7():
    base = tables.jdbc_options("jdbc:x", "t", driver="d", user="u", password="p")
    assert base == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "driver": "d", "user": "u", "password": "p"}
    cut = tables.jdbc_options("jdbc:x", "t", partition_column="win_start", lower="2024-01-01", upper="2024-02-01", partitions=8)
    assert (cut["partitionColumn"], cut["numPartitions"]) == ("win_start", "8")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", partition_column="win_start")


def test_jdbc_writer_k3_k4():
    """The call a micro-batch makes, without a database."""
    calls = []

    class Writer:
        def mode(self, m):
            calls.append(m)
            return self

        def jdbc(self, **kw):
            calls.append(kw)

    class Batch:
        write = Writer()

    sinks.JdbcAppend("jdbc:x", "stats", batch_size=1, user="u")(Batch(), 7)
    assert calls == ["append", {"url": "jdbc:x", "table": "stats", "properties": {"user": "u", "batchsize": "1"}}]


def stats(spark, *rows):
    df = spark.createDataFrame(
        [(k, s, t) for k, s, t in rows], "greenhouse_id string, s string, avg_temp double"
    )
    start = F.col("s").cast("timestamp")
    return df.select(
        "greenhouse_id",
        start.alias("win_start"),
        (start + F.expr("INTERVAL 5 SECONDS")).alias("win_end"),
        "avg_temp",
        F.lit(1.234).alias("avg_humidity"),
        F.lit(None).cast("double").alias("avg_soil_humidity"),
        F.lit(5.0).alias("max_light"),
    )


def lines(path):
    return [x for f in sorted(glob.glob(f"{path}/part-*")) for x in open(f, encoding="utf-8").read().splitlines()]


def test_window_csv_k5(spark, tmp_path):
    t = stats(spark, ("gh_01", "2024-01-01 00:00:00", 31.005), ("gh_09", "2024-01-01 00:00:05", 30.0), (None, "2024-01-01 00:00:10", 29.0))
    exports.write_csv(reports.window_export(t, True), f"{tmp_path}/out")
    head, *rows = lines(f"{tmp_path}/out")
    assert head.startswith("大棚,窗口开始,窗口结束,平均温度(℃)")
    assert rows == [
        ",2024-01-01 00:00:10,2024-01-01 00:00:15,29.0,1.23,,5.0",
        "gh_09,2024-01-01 00:00:05,2024-01-01 00:00:10,30.0,1.23,,5.0",
        "大棚一,2024-01-01 00:00:00,2024-01-01 00:00:05,31.01,1.23,,5.0",
    ]


def test_compare_csv_k6(spark, tmp_path):
    t = compare.load_windows(stats(spark, ("gh_01", "2024-01-01 00:00:00", 31.0), ("gh_02", "2024-01-01 00:00:00", 30.0)))
    exports.write_csv(compare.compare_export(t, t), f"{tmp_path}/out")
    head, *rows = lines(f"{tmp_path}/out")
    assert head.count(",") == 14
    assert rows[0] == "大棚一,2024-01-01 00:00:00,2024-01-01 00:00:05,31.0,31.0,0.0,1.23,1.23,0.0,,,,5.0,5.0,0.0"


def test_json_reports_k10(spark, tmp_path):
    t = stats(spark, ("gh_01", "2024-01-01 00:00:00", 25.0), ("gh_01", "2024-01-01 00:00:05", 31.0))
    exports.write_json(alarms.payload(alarms.alarms(alarms.history(t))), f"{tmp_path}/out")
    (got,) = map(json.loads, lines(f"{tmp_path}/out"))
    assert got["ok"] and got["confidence"] == got["primary"]["score"] == 85
    assert got["window"]["win_start"] == "2024-01-01 00:00:05" and got["window"]["recent_high_count"] == 1
    assert got["prev_window"]["temp"] == 25.0
    assert [r["score"] for r in got["reasons"]] == [85, 80] and len(got["secondary"]) == 1
    named = compare.load_windows(t)
    health = compare.engine_stats(t, F.lit("2024-01-01 00:01:00").cast("timestamp"))
    rows = compare.compare_payload(align(named, named), health, health, "大棚一").collect()
    assert sorted(r["section"] for r in rows) == ["aligned", "aligned", "left", "right"]
    assert json.loads([r["value"] for r in rows if r["section"] == "left"][0])["windows"] == 2


def test_read_parquet_legacy_s7_p6(spark, tmp_path):
    t = stats(spark, ("gh_01", "2024-01-01 00:00:00", 25.0))
    t.drop("greenhouse_id").write.parquet(f"{tmp_path}/legacy")
    got = tables.read_parquet(spark, f"{tmp_path}/legacy")
    assert got.columns == list(tables.COLUMNS) and got.first()["greenhouse_id"] is None
