"""Streams replayed from staged files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from verdance.model import FEED_METRICS, READING, WindowSpec
from verdance.operators import windowing
from verdance.session import ROCKSDB, shared_dir, streaming_session
from verdance.sources import readings as src
from verdance.sources import tables
from verdance.streaming import jobs, sinks

LATE = [[(1000, 1), (3000, 2)], [(14999, 5)], [(15000, 6)], [(4000, 100)], [(4001, 100), (40000, 0)]]


def stage(path, batches, key="gh_01"):
    """One text file of JSON messages per micro-batch, oldest first."""
    os.makedirs(path)
    for i, batch in enumerate(batches):
        name = f"{path}/{i:03d}.json"
        with open(name, "w") as f:
            for ms, v in batch:
                f.write(
                    f'{{"greenhouse_id":"{key}","air_temp":{v},"air_humidity":{v},"soil_humidity":{v},"light":{v},"timestamp":{ms}}}\n'
                )
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    return path


def stream(spark, path):
    return src.parse(src.text_stream(spark, path, max_files=1))


def batch(spark, path):
    return src.parse(spark.read.text(path))


def seconds(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds())


@pytest.mark.parametrize("strict, expected", [(True, 1.5), (False, 34.3333)])
def test_late_readings_w6(spark, tmp_path, strict, expected):
    s = streaming_session(spark)
    s.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", str(not strict).lower())
    path = stage(f"{tmp_path}/in", LATE)
    windows = windowing.tumbling_avg_max(stream(s, path))
    q = sinks.table_writer(windows, f"{tmp_path}/out", f"{tmp_path}/chk", "late", every=None).start()
    q.awaitTermination()
    got = {seconds(r["win_start"]): r["avg_temp"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[0] == pytest.approx(expected, abs=1e-4)
    drops = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]]
    assert sum(drops) == (2 if strict else 1)


def test_window_closes_when_watermark_reaches_its_end_w5(spark, tmp_path):
    s = streaming_session(spark)
    for last, closed in ((14999, set()), (15000, {0})):
        path = stage(f"{tmp_path}/in{last}", [[(1000, 1)], [(last, 5)]])
        windows = windowing.tumbling_trimmed_mean(stream(s, path))
        out = f"{tmp_path}/out{last}"
        sinks.table_writer(windows, out, f"{tmp_path}/chk{last}", f"close{last}", every=None).start().awaitTermination()
        got = spark.read.schema(windows.schema).parquet(out).collect()
        assert {seconds(r["win_start"]) for r in got} == closed


def many_batches(n=6):
    return [[(1000 * (7 * b + i), (13 * b + 5 * i) % 17) for i in range(9)] for b in range(n)]


def test_stream_equals_batch_for_closed_windows_w1_w7(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches())
    s = streaming_session(spark)
    q = jobs.event_time_job(stream(s, path), sinks.BatchFolders(f"{tmp_path}/out"), f"{tmp_path}/chk", every=None).start()
    q.awaitTermination()
    whole = batch(spark, path)
    newest = whole.agg(F.max("event_time")).first()[0]
    closed = windowing.tumbling_trimmed_mean(whole).where(F.col("win_end") <= newest - dt.timedelta(seconds=10))
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, closed.collect()))
    assert got.count() > 3


def test_resume_from_checkpoint_w9(spark, tmp_path):
    """Half of the input, a stop, the rest: state and offsets come from the checkpoint."""
    data = many_batches()
    path = stage(f"{tmp_path}/in", data[:3])
    s = streaming_session(spark)

    def run():
        w = windowing.tumbling_avg_max(stream(s, path))
        sinks.table_writer(w, f"{tmp_path}/out", f"{tmp_path}/chk", "resumed", every=None).start().awaitTermination()

    run()
    for i, b in enumerate(data[3:], 3):
        other = stage(f"{tmp_path}/more{i}", [b])
        target = f"{path}/{i:03d}.json"
        with open(f"{other}/000.json") as f, open(target, "w") as g:
            g.write(f.read())
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    run()
    whole = batch(spark, path)
    newest = whole.agg(F.max("event_time")).first()[0]
    closed = windowing.tumbling_avg_max(whole).where(F.col("win_end") <= newest - dt.timedelta(seconds=10))
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, got.collect())) == sorted(map(str, closed.collect()))


def test_table_by_day_is_pruned(spark, tmp_path):
    day = 86_400_000
    path = stage(f"{tmp_path}/in", [[(1000, 1), (day + 1000, 2)], [(2 * day + 1000, 3), (3 * day, 4)]])
    w = windowing.tumbling_avg_max(stream(streaming_session(spark), path))
    sinks.table_writer(w, f"{tmp_path}/out", f"{tmp_path}/chk", "days", every=None, by_day=True).start().awaitTermination()
    assert sorted(r["avg_temp"] for r in tables.read_parquet(spark, f"{tmp_path}/out").collect()) == [1.0, 2.0, 3.0]
    later = tables.read_parquet(spark, f"{tmp_path}/out", "1970-01-02 00:00:01")
    assert [r["avg_temp"] for r in later.where(F.col("avg_temp") < 3).collect()] == []
    assert [r["avg_temp"] for r in later.collect()] == [3.0]
    text = later._jdf.queryExecution().executedPlan().toString()
    assert "day#" in text.split("PartitionFilters: [")[1].split("]")[0]
    plain = tables.read_parquet(spark, f"{tmp_path}/out", "1970-01-02 00:00:00")
    assert sorted(r["avg_temp"] for r in plain.collect()) == [2.0, 3.0]


def test_retried_batch_leaves_no_repeats_k3(spark, tmp_path):
    write = sinks.BatchFolders(f"{tmp_path}/out")
    df = spark.range(5)
    for batch_id in (0, 1, 1):
        write(df, batch_id)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10


def test_failing_sink_ends_the_query_n8(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches(2))

    def broken(df, batch_id):
        raise RuntimeError("sink is down")

    w = windowing.tumbling_avg_max(stream(streaming_session(spark), path))
    q = sinks.batch_writer(w, broken, f"{tmp_path}/chk", "broken", every=None).start()
    with pytest.raises(Exception, match="sink is down"):
        q.awaitTermination()


def test_sliding_stream_equals_batch_w2(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches())
    s = streaming_session(spark)

    def feed(df, checkpoint, every):
        return sinks.batch_writer(df, sinks.BatchFolders(f"{tmp_path}/out"), checkpoint, "sliding", "update", every)

    jobs.sliding_job(stream(s, path), feed, f"{tmp_path}/chk").start().awaitTermination()
    got = sinks.last_update(spark.read.parquet(f"{tmp_path}/out"), ["greenhouse_id", "ts"], list(FEED_METRICS))
    want = windowing.sliding_avg(batch(spark, path))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_sliding_by_panes_equals_built_in_a2(spark):
    rows = [(f"gh_0{i % 3 + 1}", float(i * 7 % 31), float(i % 5), None if i % 4 else 2.0, 1.0, 700 * i) for i in range(200)]
    r = spark.createDataFrame(rows, READING).withColumn("event_time", F.timestamp_millis("timestamp"))
    spec = WindowSpec(seconds=6, slide_seconds=2, offset_seconds=1)
    panes = windowing.sliding_avg(r, spec)
    w = r.groupBy("greenhouse_id", F.window("event_time", spec.size, spec.slide, spec.offset)).agg(
        *[F.avg(m).alias(f) for m, f in zip(READING.fieldNames()[1:5], FEED_METRICS)]
    )
    built_in = w.select("greenhouse_id", F.col("window.end").alias("ts"), *FEED_METRICS)
    got = {(r[0], r[1]): r[2:] for r in panes.collect()}
    want = {(r[0], r[1]): r[2:] for r in built_in.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_uneven_slide_uses_built_in_windows(spark):
    r = spark.createDataFrame([("gh_01", 1.0, 1.0, 1.0, 1.0, 5500)], READING).withColumn(
        "event_time", F.timestamp_millis("timestamp")
    )
    got = windowing.sliding_avg(r, WindowSpec(seconds=5, slide_seconds=3)).collect()
    assert sorted(seconds(x["ts"]) for x in got) == [8]


def test_window_offset_w1(spark):
    r = spark.createDataFrame([("gh_01", 1.0, 1.0, 1.0, 1.0, 5500)], READING).withColumn(
        "event_time", F.timestamp_millis("timestamp")
    )
    assert seconds(windowing.tumbling_avg_max(r).first()["win_start"]) == 5
    assert seconds(windowing.tumbling_avg_max(r, WindowSpec(offset_seconds=2)).first()["win_start"]) == 2


def test_table_and_feed_from_one_stream_k8_w4_w12(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches(3))
    s = streaming_session(spark)

    def feed(df, checkpoint, every):
        return sinks.batch_writer(df, sinks.BatchFolders(f"{tmp_path}/feed"), checkpoint, "arrival_feed", "update", every)

    writers = jobs.arrival_time_jobs(
        stream(s, path), sinks.BatchFolders(f"{tmp_path}/table"), feed, f"{tmp_path}/chk", table_every=None, feed_every=None
    )
    table, live = sinks.start_all(*writers)
    table.awaitTermination()
    live.awaitTermination()
    assert {table.name, live.name} == {"arrival_table", "arrival_feed"} and table.id != live.id
    got = spark.read.parquet(f"{tmp_path}/feed")
    assert got.columns[:6] == ["greenhouse_id", "ts", *FEED_METRICS]
    assert got.agg(F.max("light_avg")).first()[0] == max(v for b in many_batches(3) for _, v in b)


def test_any_end_stops_all_w12(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches(2))
    s = streaming_session(spark)
    w = windowing.tumbling_avg_max(stream(s, path))
    once = sinks.table_writer(w, f"{tmp_path}/a", f"{tmp_path}/ca", "once", every=None)
    forever = sinks.table_writer(w, f"{tmp_path}/b", f"{tmp_path}/cb", "forever", every=1)
    sinks.run_until_any_ends(s, once, forever, timeout=120)
    assert s.streams.active == []


def test_any_end_watches_its_own_queries_w12(spark, tmp_path):
    """A second call in the session, the caller's own session, and a healthy pair that times out."""
    path = stage(f"{tmp_path}/in", many_batches(1))
    s = streaming_session(spark)
    w = windowing.tumbling_avg_max(stream(s, path))

    def writer(name, every):
        return sinks.table_writer(w, f"{tmp_path}/{name}", f"{tmp_path}/c{name}", name, every=every)

    assert sinks.run_until_any_ends(s, writer("a", None), timeout=120) is True
    assert sinks.run_until_any_ends(s, writer("b", 1), writer("c", 1), timeout=3) is False
    assert sinks.run_until_any_ends(spark, writer("d", None), writer("e", 1), timeout=120) is True
    assert s.streams.active == []


def test_any_end_raises_the_failure_w12(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches(1))
    s = streaming_session(spark)
    w = windowing.tumbling_avg_max(stream(s, path))

    def broken(batch, batch_id):
        raise RuntimeError("sink is gone")

    bad = sinks.batch_writer(w, broken, f"{tmp_path}/cx", "bad", every=None)
    good = sinks.table_writer(w, f"{tmp_path}/y", f"{tmp_path}/cy", "good", every=1)
    with pytest.raises(Exception, match="sink is gone"):
        sinks.run_until_any_ends(s, bad, good, timeout=120)
    assert s.streams.active == []


def test_streaming_session_w11(spark):
    s = streaming_session(spark)
    assert s.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    assert spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple") == "true"
    assert s.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_append_needs_a_watermark_w7(spark, tmp_path):
    path = stage(f"{tmp_path}/in", many_batches(1))
    r = stream(streaming_session(spark), path)
    bare = r.groupBy("greenhouse_id", F.window("event_time", "5 seconds")).count()
    with pytest.raises(Exception, match="(?i)watermark"):
        sinks.table_writer(bare, f"{tmp_path}/o", f"{tmp_path}/c", "bare", every=None).start()


def test_shared_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")


def test_kafka_needs_its_connector_s1_k1(spark, tmp_path):
    """The container has no Kafka connector: the builders get as far as looking it up."""
    path = stage(f"{tmp_path}/in", many_batches(1))
    s = streaming_session(spark)
    feed = windowing.as_feed(windowing.tumbling_avg_max(stream(s, path)))
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.feed_writer(feed, "localhost:1", "out", f"{tmp_path}/c", "feed").start()
    with pytest.raises(Exception, match="(?i)kafka"):
        src.KafkaTopic("localhost:1", "in").stream(s)
