"""Replays, keyed tables, ledgers and restarts."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from verdance.model import WindowSpec
from verdance.operators import windowing
from verdance.session import streaming_session
from verdance.sources import readings as src
from verdance.streaming import keyed, replay, sinks

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "greenhouse_id string, win_start timestamp, win_end timestamp, avg_temp double, avg_humidity double, avg_soil_humidity double, max_light double"
READINGS = "batch int, greenhouse_id string, event_time timestamp, air_temp double, air_humidity double, soil_humidity double, light double"


def windows(spark, *rows):
    """(greenhouse, hour, temperature); a null temperature is a value like others."""
    at = lambda h: T0 + dt.timedelta(hours=h)
    return spark.createDataFrame([(g, at(h), at(h + 1), t, 1.0, None, 3.0) for g, h, t in rows], SCHEMA)


def held(table, spark):
    return sorted(((r["greenhouse_id"], int((r["win_start"] - T0).total_seconds() // 3600), r["avg_temp"]) for r in table.read(spark).collect()), key=repr)


def test_keyed_table_takes_the_newest_row_of_a_key(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path))
    assert held(table, spark) == []
    table(windows(spark, ("a", 0, 1.0), ("a", 30, 2.0), (None, 0, 3.0)), 0)
    table(windows(spark, ("a", 0, None), ("b", 1, 5.0)), 1)
    want = [("a", 0, None), ("a", 30, 2.0), ("b", 1, 5.0), (None, 0, 3.0)]
    assert held(table, spark) == sorted(want, key=repr)
    days = {(r["batch_id"], str(r["day"])) for r in table._newest(spark, None).collect()}
    assert days == {(1, "2024-01-01"), (0, "2024-01-02")}  # the second day was not rewritten


def test_keyed_table_takes_repeats_and_breakdowns(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path))
    first, second, third = windows(spark, ("a", 0, 1.0)), windows(spark, ("a", 0, 2.0), ("b", 0, 7.0)), windows(spark, ("a", 0, 3.0))
    table(first, 0)
    table(second, 1)
    table(second, 1)
    assert held(table, spark) == [("a", 0, 2.0), ("b", 0, 7.0)]
    # rows are written but not noted: nobody sees them, and the batch comes again
    third.withColumn("day", F.to_date("win_start")).write.partitionBy("day").parquet(f"{tmp_path}/data/batch_id=2")
    assert held(table, spark) == [("a", 0, 2.0), ("b", 0, 7.0)]
    table(third, 2)
    assert held(table, spark) == [("a", 0, 3.0), ("b", 0, 7.0)]
    assert table.vacuum(spark) == 2 and table.vacuum(spark) == 0
    assert held(table, spark) == [("a", 0, 3.0), ("b", 0, 7.0)]
    assert not os.path.exists(f"{tmp_path}/incoming/batch_id=2")


def test_keyed_table_skips_days_it_does_not_need(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path))
    for i in range(4):
        table(windows(spark, *[("a", 24 * i + h, 1.0) for h in range(3)]), i)
    plan = table.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "BroadcastHashJoin" in plan
    files = table.read(spark).inputFiles()
    assert len({f.split("data/")[1].split("/")[0] for f in files if "/data/" in f}) == 4


def readings(spark, batches):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [(b, "g", at(s), float(v), 1.0, 1.0, 1.0) for b, batch in enumerate(batches) for s, v in batch]
    return spark.createDataFrame(rows, READINGS)


LATE = [[(1, 1), (3, 2)], [(14, 5)], [(15, 6)], [(4, 100)], [(2, 100), (40, 0)]]
SPEC = WindowSpec(seconds=5, watermark="10 seconds")


def test_replay_keeps_the_order_and_counts_late_groups(spark, tmp_path):
    assert replay.stage(readings(spark, LATE), f"{tmp_path}/in") == [0, 1, 2, 3, 4]
    s = streaming_session(spark)
    stream = replay.staged_stream(s, f"{tmp_path}/in", READINGS.partition(", ")[2])
    out = windowing.tumbling_avg_max(stream, SPEC)
    query = sinks.table_writer(out, f"{tmp_path}/out", f"{tmp_path}/chk", "replayed", every=None).start()
    query.awaitTermination()
    assert replay.batch_counts(query) == [(0, 2, 0), (1, 1, 0), (2, 1, 0), (3, 1, 1), (4, 2, 1)]
    got = {(r["win_start"] - T0).seconds: r["avg_temp"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 1.5, 10: 5.0, 15: 6.0}


def test_restarts_resume_from_the_checkpoint(spark, tmp_path):
    replay.stage(readings(spark, LATE), f"{tmp_path}/in")
    sink = replay.Interrupted(sinks.BatchFolders(f"{tmp_path}/out"), before=(0, 3), after=(1, 4))

    def build():
        stream = replay.staged_stream(streaming_session(spark), f"{tmp_path}/in", READINGS.partition(", ")[2])
        return sinks.batch_writer(windowing.tumbling_avg_max(stream, SPEC), sink, f"{tmp_path}/chk", "resumed", every=None)

    replay.run_with_restarts(build, restarts=4)
    got = {(r["win_start"] - T0).seconds: r["avg_temp"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 1.5, 10: 5.0, 15: 6.0}


def test_restarts_end(spark, tmp_path):
    replay.stage(readings(spark, LATE[:1]), f"{tmp_path}/in")

    def broken(batch, batch_id):
        raise ValueError("never")

    def build():
        stream = replay.staged_stream(streaming_session(spark), f"{tmp_path}/in", READINGS.partition(", ")[2])
        return sinks.batch_writer(stream, broken, f"{tmp_path}/chk", "broken", every=None)

    with pytest.raises(StreamingQueryException, match="never"):
        replay.run_with_restarts(build, restarts=2)


def test_arrival_ledger_keeps_the_first_time(spark, tmp_path):
    first = keyed.ArrivalLedger(f"{tmp_path}/ledger", lambda i: T0 + dt.timedelta(seconds=i))
    later = keyed.ArrivalLedger(f"{tmp_path}/ledger", lambda i: T0 + dt.timedelta(days=9))
    assert first.stamp(spark, 3).first()[0] == later.stamp(spark, 3).first()[0] == T0 + dt.timedelta(seconds=3)
    now = keyed.ArrivalLedger(f"{tmp_path}/now")
    assert now.stamp(spark, 0).collect() == now.stamp(spark, 0).collect()


def test_arrival_windows_after_a_retry(spark, tmp_path):
    ledger = keyed.ArrivalLedger(f"{tmp_path}/ledger", lambda i: T0 + dt.timedelta(seconds=3 * i))
    table = keyed.ArrivalWindows(f"{tmp_path}/sums", ledger, WindowSpec(seconds=5))
    for i, rows in enumerate(LATE[:3]):
        for _ in range(1 + i % 2):
            table(readings(spark, [rows]), i)
    got = sorted(((r["win_start"] - T0).seconds, r["avg_temp"], r["n"]) for r in table.read(spark).collect())
    assert got == [(0, (1 + 2 + 5) / 3, 3), (5, 6.0, 1)]


def test_fanout_gives_each_sink_the_same_batch(spark, tmp_path):
    table = keyed.KeyedTable(f"{tmp_path}/table")
    both = keyed.Fanout(table, keyed.FeedFolders(f"{tmp_path}/feed"))
    both(windows(spark, ("a", 0, 1.0), ("b", 0, 2.5)), 0)
    both(windows(spark, ("a", 0, 4.0)), 1)
    assert held(table, spark) == [("a", 0, 4.0), ("b", 0, 2.5)]
    messages = src.parse_feed(keyed.feed_messages(streaming_session(spark), f"{tmp_path}/feed"), ("sent",))
    sink = sinks.BatchFolders(f"{tmp_path}/got")
    sinks.batch_writer(messages, sink, f"{tmp_path}/chk", "consumer", every=None).start().awaitTermination()
    got = keyed.newest_messages(spark.read.schema(messages.schema).parquet(f"{tmp_path}/got")).collect()
    assert sorted((r["greenhouse_id"], r["air_temp_avg"], r["soil_humidity_avg"]) for r in got) == [("a", 4.0, None), ("b", 2.5, None)]
