"""``queries()``: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.catalog import frames as fr
from verdance.functions import labels
from verdance.model import FEED_METRICS, METRICS, SHORT, STATS
from verdance.operators import tables, windowing
from verdance.operators.align import align, audit_join
from verdance.operators.priority import keyed_source, priority_source
from verdance.plans import alarms, compare, facts, questions, reports
from verdance.sources import readings as src
from verdance.streaming import keyed, replay, sinks
from verdance.session import run_dir, streaming_session

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of the report on the newest windows.
NEWEST = 100

# ---------------------------------------------------------------- ingest


def readings(spark, sf):
    return src.accepted(src.parse_strict(fr.messages(spark, sf), ("event_id",)))


def rejected_readings(spark, sf):
    bad = src.rejected(src.parse_strict(fr.messages(spark, sf)))
    return bad.groupBy("reject").agg(F.count("*").alias("n"))


def lenient_readings(spark, sf):
    return src.parse(fr.messages(spark, sf), ("event_id",))


def topic_fanout(spark, sf):
    r = fr.readings(spark, sf).select("event_id", "greenhouse_id", *METRICS)
    return sinks.to_topics(sinks.as_message(r, "greenhouse_id"), "readings_a", "readings_b")


# ---------------------------------------------------------------- windows


def tumbling_avg_max(spark, sf):
    return fr.left(spark, sf)


def tumbling_trimmed_mean(spark, sf):
    return fr.right(spark, sf)


def trimmed_mean_doubles(spark, sf):
    """Doubles as the permissive parse yields them, with outliers."""
    return windowing.tumbling_trimmed_mean(src.parse(fr.outlier_messages(spark, sf)), fr.DOUBLES)


def tumbling_avg_doubles(spark, sf):
    """Means of what the strict parse accepts, which refuses the outliers."""
    w = windowing.tumbling_avg_max(src.accepted(src.parse_strict(fr.outlier_messages(spark, sf))), fr.DOUBLES)
    return w.withColumns({s: F.round(s, 4) for s in STATS})


def rejected_outliers(spark, sf):
    bad = src.rejected(src.parse_strict(fr.outlier_messages(spark, sf)))
    return bad.groupBy("reject").agg(F.count("*").alias("n"))


def sliding_avg(spark, sf):
    return windowing.sliding_avg(fr.readings(spark, sf), fr.SLIDING)


def feed(spark, sf):
    return windowing.as_feed(fr.left(spark, sf))


def json_payload(spark, sf):
    return sinks.as_message(windowing.as_feed(fr.right(spark, sf)), "greenhouse_id")


# ---------------------------------------------------------------- window tables


def dedup_windows(spark, sf):
    return tables.dedup_windows(fr.repeated(fr.left(spark, sf)))


def duplicate_windows(spark, sf):
    return tables.duplicate_windows(fr.repeated(fr.left(spark, sf)), fr.as_of(spark, sf), fr.AUDIT_MINUTES)


def key_counts(spark, sf):
    return tables.key_counts(fr.unkeyed(fr.left(spark, sf), "gh_02"))


def key_rows(spark, sf):
    return tables.key_rows(fr.unkeyed(fr.left(spark, sf), "gh_02"), ("gh_01", "大棚一", "1", None))


def key_probe(spark, sf):
    return tables.probe_key(fr.left(spark, sf))


def normalized_labels(spark, sf):
    key = F.col("greenhouse_id")
    name = labels.normalized(key)
    spelled = F.concat(F.lit("  "), F.upper(key), F.lit(" "))
    return fr.readings(spark, sf).select(
        "event_id",
        name.alias("greenhouse"),
        labels.normalized(spelled).alias("from_spelling"),
        labels.normalized(F.right(key, F.lit(1))).alias("from_digit"),
        labels.normalized(F.concat(key, F.lit("9"))).alias("unknown_key"),
        labels.normalized(F.lit("  ")).alias("blank_key"),
        labels.key_of(name).alias("back"),
    )


def synthetic_labels(spark, sf):
    at = F.col("event_time")
    as_text = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    return fr.readings(spark, sf).select(
        "event_id",
        labels.synthetic(at).alias("by_time"),
        labels.synthetic_text(as_text).alias("by_text"),
        labels.synthetic_text(F.date_format(at, "yyyy-MM-dd")).alias("by_code_points"),
        labels.label(F.when(F.col("event_type") == "click", F.col("greenhouse_id")), at).alias("label"),
    )


# ---------------------------------------------------------------- comparison


def engine_stats(spark, sf):
    now = fr.as_of(spark, sf)

    def one(name, table):
        return compare.engine_stats(table, now, fr.ALIVE_SECONDS).select(F.lit(name).alias("engine"), "*")

    return one("left", fr.left(spark, sf)).unionByName(one("right", fr.right(spark, sf)))


def engine_align(spark, sf):
    return align(fr.labelled(fr.left(spark, sf)), fr.labelled(fr.right(spark, sf)))


def engine_align_null_left(spark, sf):
    return align(fr.unkeyed(fr.left(spark, sf), "gh_01", "gh_02"), fr.labelled(fr.right(spark, sf)))


def engine_align_null_right(spark, sf):
    return align(fr.labelled(fr.left(spark, sf)), fr.unkeyed(fr.right(spark, sf), "gh_01", "gh_02"))


def _stored_pair(spark, sf):
    return fr.stored(fr.left(spark, sf), "left"), fr.stored(fr.right(spark, sf), "right")


def engine_align_one(spark, sf):
    l, r = _stored_pair(spark, sf)
    return compare.compare_report(fr.labelled(l), fr.labelled(r), greenhouse="大棚二")


def engine_diff(spark, sf):
    l, r = _stored_pair(spark, sf)
    return compare.engine_diff(fr.labelled(l), fr.labelled(r), fr.as_of(spark, sf), alive_seconds=fr.ALIVE_SECONDS)


def compare_export(spark, sf):
    l, r = fr.labelled(fr.left(spark, sf)), fr.labelled(fr.right(spark, sf))
    return compare.compare_export(fr.bucketed(l, "left"), fr.bucketed(r, "right"))


def audit(spark, sf):
    return audit_join(fr.unkeyed(fr.repeated(fr.left(spark, sf)), "gh_01"), fr.right(spark, sf))


def priority(spark, sf):
    return priority_source(fr.gappy(spark, sf), fr.right(spark, sf), F.col("avg_temp") > 30)


def priority_backup(spark, sf):
    """The primary has no hot window, so the backup's count."""
    return priority_source(fr.cool(fr.left(spark, sf)), fr.right(spark, sf), F.col("avg_temp") > 30)


def priority_by_greenhouse(spark, sf):
    return priority_source(fr.cool(fr.left(spark, sf), "gh_03"), fr.right(spark, sf), F.col("avg_temp") > 30, "greenhouse_id")


def report_source(spark, sf):
    """Ranking from the first table with several keys, which is the second."""
    table, real = keyed_source(_unnamed(spark, sf), fr.right(spark, sf))
    return reports.gh_rank(table).withColumn("real_keys", real)


# ---------------------------------------------------------------- alarms


def _history(spark, sf):
    return alarms.history(fr.gappy(spark, sf), fr.right(spark, sf), fr.ALARM, fr.HOUR)


def previous_window(spark, sf):
    h = alarms.history(fr.left(spark, sf), None, fr.ALARM, fr.HOUR)
    prev = [F.col(f"prev.{s}").alias(f"prev_{SHORT[s]}") for s in STATS]
    return h.select("greenhouse", "win_start", F.col("prev.win_start").alias("prev_start"), *prev)


def recent_hot_count(spark, sf):
    h = alarms.history(fr.left(spark, sf), None, fr.ALARM, fr.HOUR)
    return h.select("greenhouse", "win_start", F.col("left.avg_temp").alias("avg_temp"), "recent_hot")


def look_back_two_tables(spark, sf):
    return _history(spark, sf).select(
        "greenhouse",
        "win_start",
        F.coalesce("left.avg_temp", "right.avg_temp").alias("avg_temp"),
        F.col("prev.win_start").alias("prev_start"),
        F.col("prev.avg_temp").alias("prev_temp"),
        "recent_hot",
    )


def alarm_reasons(spark, sf):
    h = alarms.history(fr.left(spark, sf), None, fr.ALARM, fr.HOUR)
    return alarms.reason_rows(alarms.alarms(h, fr.ALARM))


def alarm_reasons_two_tables(spark, sf):
    return alarms.reason_rows(alarms.alarms(_history(spark, sf), fr.ALARM))


def _brief(attributed):
    return attributed.select(
        "greenhouse",
        "win_start",
        "win_end",
        "avg_temp",
        F.col("prev.win_start").alias("prev_start"),
        "recent_hot",
        F.col("primary.rule").alias("rule"),
        F.col("primary.reason").alias("reason"),
        F.size("secondary").alias("others"),
        "confidence",
    )


def alarm_primary(spark, sf):
    h = alarms.history(fr.left(spark, sf), None, fr.ALARM, fr.HOUR)
    return _brief(alarms.alarms(h, fr.ALARM))


def _stored_gappy(spark, sf):
    return fr.stored(fr.gappy(spark, sf), "gappy"), fr.stored(fr.right(spark, sf), "right")


def alarm_at_window(spark, sf):
    l, r = _stored_gappy(spark, sf)
    hot = r.where(F.col("avg_temp") > 30).agg(F.min("win_start")).scalar()
    return _brief(alarms.alarms_at(l, r, hot, fr.ALARM, fr.HOUR))


def _latest(spark, sf, greenhouse=None):
    return alarms.latest_alarm(*_stored_gappy(spark, sf), fr.ALARM, fr.HOUR, greenhouse)


def alarm_latest(spark, sf):
    return _brief(_latest(spark, sf))


def alarm_latest_one(spark, sf):
    return _brief(_latest(spark, sf, "大棚三"))


def alarm_payload(spark, sf):
    h = alarms.history(fr.left(spark, sf), None, fr.ALARM, fr.HOUR)
    return alarms.payload(alarms.alarms(h, fr.ALARM))


def compare_payload(spark, sf):
    (l, r), now = _stored_pair(spark, sf), fr.as_of(spark, sf)
    pairs = align(fr.labelled(l), fr.labelled(r))
    health = [compare.engine_stats(t, now, fr.ALIVE_SECONDS) for t in (l, r)]
    return compare.compare_payload(pairs, *health)


# ---------------------------------------------------------------- reports


def alarm_count(spark, sf):
    w = fr.left(spark, sf)
    total = reports.alarm_count(w).select(F.lit("所有大棚").alias("greenhouse"), "*")
    one = reports.alarm_count(w, "大棚二").select(F.lit("大棚二").alias("greenhouse"), "*")
    return total.unionByName(one)


def alarm_top(spark, sf):
    return reports.alarm_top(fr.left(spark, sf))


def alarm_top_synthetic(spark, sf):
    return reports.alarm_top_synthetic(fr.left(spark, sf), window_seconds=fr.HOUR)


def gh_rank(spark, sf):
    return reports.gh_rank(fr.left(spark, sf))


def gh_rank_synthetic(spark, sf):
    return reports.gh_rank_synthetic(fr.left(spark, sf), window_seconds=fr.HOUR)


def gh_latest(spark, sf):
    return reports.gh_latest(fr.labelled(fr.left(spark, sf)))


def gh_latest_synthetic(spark, sf):
    return reports.gh_latest(tables.labelled(tables.dedup_windows(_unnamed(spark, sf)), False, fr.HOUR))


def _unnamed(spark, sf):
    """One-greenhouse table: every reading under the default key."""
    one = fr.readings(spark, sf).withColumn("greenhouse_id", F.lit("gh_01"))
    return windowing.tumbling_avg_max(one, fr.SPEC)


def gh_compare(spark, sf):
    return reports.gh_compare(fr.labelled(fr.left(spark, sf)), "大棚一", "大棚二")


def gh_compare_synthetic(spark, sf):
    w = tables.labelled(_unnamed(spark, sf), False, fr.HOUR)
    return reports.gh_compare(w, "大棚一", "大棚二")


def newest_windows(spark, sf):
    """The newest windows, as many as the caller asks for."""
    return reports.window_export(fr.right(spark, sf), newest=NEWEST, window_seconds=fr.HOUR)


def window_export(spark, sf):
    w = fr.right(spark, sf)
    return reports.window_export(w, tables.multi_key(w), window_seconds=fr.HOUR)


def window_export_synthetic(spark, sf):
    w = _unnamed(spark, sf)
    return reports.window_export(w, tables.multi_key(w), window_seconds=fr.HOUR)


# ---------------------------------------------------------------- questions


def route_questions(spark, sf):
    return questions.route(fr.questions(spark, sf))


def question_records(spark, sf):
    return questions.records(fr.questions(spark, sf))


def _facts(spark, left, right):
    """Facts of whichever of two stored tables has real keys, else of the first, by time."""
    rows, real = keyed_source(left, right)
    return facts.facts(rows, real, facts.known_names(spark), window_seconds=fr.HOUR)


def _keyless(spark, sf):
    """Two tables without real keys: one without the column, one with a single value in it."""
    left = fr.stored(fr.left(spark, sf), "keyless").drop("greenhouse_id")
    return left, fr.stored(fr.right(spark, sf).withColumn("greenhouse_id", F.lit("gh_01")), "single")


def _engines_and_alarm(spark, sf, left, right):
    """The first table labelled, the engines' difference and the latest alarm."""
    named = [compare.load_windows(t, w, window_seconds=fr.HOUR) for t, w in ((left, True), (right, True))]
    diff = compare.engine_diff(*named, fr.as_of(spark, sf), alive_seconds=fr.ALIVE_SECONDS)
    gappy = fr.stored(fr.gappy(spark, sf), "gappy")
    return named[0], diff, alarms.latest_alarm(gappy, right, fr.ALARM, fr.HOUR)


def _answered(spark, sf, left, right):
    _, diff, newest = _engines_and_alarm(spark, sf, left, right)
    return questions.answer(fr.questions(spark, sf), _facts(spark, left, right), diff, newest)


def answers(spark, sf):
    return questions.answers(*_engines_and_alarm(spark, sf, *_stored_pair(spark, sf)))


def answer_facts(spark, sf):
    return _facts(spark, fr.left(spark, sf), fr.right(spark, sf))


def answers_synthetic(spark, sf):
    return _facts(spark, *_keyless(spark, sf))


def answer_rankings(spark, sf):
    return facts.rankings(_facts(spark, *_stored_pair(spark, sf)))


def answer_rankings_synthetic(spark, sf):
    return facts.rankings(_facts(spark, *_keyless(spark, sf)))


def answer_questions(spark, sf):
    return _answered(spark, sf, *_stored_pair(spark, sf)).drop("q")


def answer_questions_synthetic(spark, sf):
    """Nothing but facts told by time."""
    return questions.answer(fr.questions(spark, sf), _facts(spark, *_keyless(spark, sf))).drop("q")


def answer_records(spark, sf):
    return questions.answer_records(_answered(spark, sf, *_stored_pair(spark, sf)))


# ---------------------------------------------------------------- streams


def _event_stream(spark, sf):
    s = streaming_session(spark)
    # as a pattern: a stream takes a folder or a pattern, and the table may be one file
    return fr.as_readings(src.parquet_stream(s, f"{sf}/{{events}}.parquet", fr.EVENTS))


def _replayed(spark, windows, name, mode="append"):
    """Runs a stream over everything available and returns the folder it wrote."""
    base = run_dir(spark, name)
    if mode == "append":
        writer = sinks.table_writer(windows, f"{base}/out", f"{base}/checkpoint", name, every=None)
    else:
        writer = sinks.batch_writer(
            windows, sinks.BatchFolders(f"{base}/out"), f"{base}/checkpoint", name, mode, every=None
        )
    writer.start().awaitTermination()
    return f"{base}/out"


def _window_table(spark, path, schema):
    return spark.read.schema(schema).parquet(path)


def stream_tumbling_avg_max(spark, sf):
    w = windowing.tumbling_avg_max(_event_stream(spark, sf), fr.SPEC)
    return _window_table(spark, _replayed(spark, w, "tumbling_avg_max"), w.schema)


def stream_tumbling_trimmed(spark, sf):
    w = windowing.tumbling_trimmed_mean(_event_stream(spark, sf), fr.SPEC)
    return _window_table(spark, _replayed(spark, w, "tumbling_trimmed"), w.schema)


def stream_sliding_avg(spark, sf):
    w = windowing.sliding_avg(_event_stream(spark, sf), fr.SLIDING)
    out = _replayed(spark, w, "sliding_avg", "update")
    return sinks.last_update(spark.read.parquet(out), ["greenhouse_id", "ts"], list(FEED_METRICS))


def _replay(spark, sf, name):
    """Events staged out of order, a file per micro-batch: the stream, and a folder for the rest."""
    base = run_dir(spark, name)
    replay.stage(fr.dealt_events(spark, sf), f"{base}/in")
    return lambda: fr.as_readings(replay.staged_stream(streaming_session(spark), f"{base}/in", fr.EVENTS)), base


def _late(spark, sf, name):
    stream, base = _replay(spark, sf, name)
    windows = windowing.tumbling_avg_max(stream(), fr.LATE)
    query = sinks.table_writer(windows, f"{base}/out", f"{base}/checkpoint", name, every=None).start()
    query.awaitTermination()
    return _window_table(spark, f"{base}/out", windows.schema), replay.batch_counts(query)


def stream_late_rows(spark, sf):
    """Windows of a stream whose rows come up to two micro-batches late: what the watermark has
    passed is dropped, the rest counts."""
    return _late(spark, sf, "late_rows")[0]


def stream_late_counts(spark, sf):
    """Rows of each micro-batch, and the greenhouse windows in it that came too late."""
    return spark.createDataFrame(_late(spark, sf, "late_counts")[1], "batch_id long, n long, late_groups long")


def stream_upsert(spark, sf):
    """Every update of every window into a keyed table; two micro-batches come twice."""
    stream, base = _replay(spark, sf, "upsert")
    table = keyed.KeyedTable(f"{base}/table")
    windows = windowing.tumbling_trimmed_mean(stream(), fr.PATIENT)
    write = replay.repeated(table, (2, 4))
    sinks.batch_writer(windows, write, f"{base}/checkpoint", "upsert", "update", every=None).start().awaitTermination()
    return table.read(spark)


def stream_resume(spark, sf):
    """The late stream, broken down in three micro-batches and started again each time."""
    stream, base = _replay(spark, sf, "resume")
    sink = replay.Interrupted(sinks.BatchFolders(f"{base}/out"), before=(2,), after=(2, 4))
    windows = lambda: windowing.tumbling_avg_max(stream(), fr.LATE)
    replay.run_with_restarts(
        lambda: sinks.batch_writer(windows(), sink, f"{base}/checkpoint", "resume", every=None), restarts=3
    )
    return _window_table(spark, f"{base}/out", windows().schema).drop("batch_id")


def _table_and_feed(spark, sf, name):
    """Updates of windows, each micro-batch to a keyed table and to the feed."""
    stream, base = _replay(spark, sf, name)
    table = keyed.KeyedTable(f"{base}/table")
    both = keyed.Fanout(table, keyed.FeedFolders(f"{base}/feed"))
    windows = windowing.tumbling_avg_max(stream(), fr.PATIENT)
    sinks.batch_writer(windows, both, f"{base}/checkpoint", name, "update", every=None).start().awaitTermination()
    return table, base


def stream_table_and_feed(spark, sf):
    return _table_and_feed(spark, sf, "table_and_feed")[0].read(spark)


def feed_consumed(spark, sf):
    """The feed of the same job read back as a stream by a second query."""
    base = _table_and_feed(spark, sf, "feed_consumed")[1]
    rows = src.parse_feed(keyed.feed_messages(streaming_session(spark), f"{base}/feed", max_files=20), ("sent",))
    sink = sinks.BatchFolders(f"{base}/consumed")
    sinks.batch_writer(rows, sink, f"{base}/consumer", "feed_consumer", every=None).start().awaitTermination()
    return keyed.newest_messages(spark.read.schema(rows.schema).parquet(f"{base}/consumed"))


def stream_processing_time(spark, sf):
    """Windows by arrival, which the ledger remembers. Here a micro-batch comes every 3 s, and two
    are taken twice."""
    stream, base = _replay(spark, sf, "processing_time")
    first = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    ledger = keyed.ArrivalLedger(f"{base}/ledger", lambda batch_id: first + dt.timedelta(seconds=3 * batch_id))
    windows = keyed.ArrivalWindows(f"{base}/sums", ledger, fr.ARRIVAL)
    write = replay.repeated(windows, (1, 3))
    sinks.batch_writer(stream(), write, f"{base}/checkpoint", "processing_time", every=None).start().awaitTermination()
    return windows.read(spark)


QUERIES: dict[str, Query] = {
    "readings": readings,
    "rejected_readings": rejected_readings,
    "lenient_readings": lenient_readings,
    "topic_fanout": topic_fanout,
    "tumbling_avg_max": tumbling_avg_max,
    "tumbling_trimmed_mean": tumbling_trimmed_mean,
    "trimmed_mean_doubles": trimmed_mean_doubles,
    "tumbling_avg_doubles": tumbling_avg_doubles,
    "rejected_outliers": rejected_outliers,
    "sliding_avg": sliding_avg,
    "feed": feed,
    "json_payload": json_payload,
    "dedup_windows": dedup_windows,
    "duplicate_windows": duplicate_windows,
    "key_counts": key_counts,
    "key_rows": key_rows,
    "key_probe": key_probe,
    "normalized_labels": normalized_labels,
    "synthetic_labels": synthetic_labels,
    "engine_stats": engine_stats,
    "engine_align": engine_align,
    "engine_align_null_left": engine_align_null_left,
    "engine_align_null_right": engine_align_null_right,
    "engine_align_one": engine_align_one,
    "engine_diff": engine_diff,
    "compare_export": compare_export,
    "audit_join": audit,
    "priority_source": priority,
    "priority_backup": priority_backup,
    "priority_by_greenhouse": priority_by_greenhouse,
    "report_source": report_source,
    "previous_window": previous_window,
    "recent_hot_count": recent_hot_count,
    "look_back_two_tables": look_back_two_tables,
    "alarm_reasons": alarm_reasons,
    "alarm_reasons_two_tables": alarm_reasons_two_tables,
    "alarm_primary": alarm_primary,
    "alarm_at_window": alarm_at_window,
    "alarm_latest": alarm_latest,
    "alarm_latest_one": alarm_latest_one,
    "alarm_payload": alarm_payload,
    "compare_payload": compare_payload,
    "alarm_count": alarm_count,
    "alarm_top": alarm_top,
    "alarm_top_synthetic": alarm_top_synthetic,
    "gh_rank": gh_rank,
    "gh_rank_synthetic": gh_rank_synthetic,
    "gh_latest": gh_latest,
    "gh_latest_synthetic": gh_latest_synthetic,
    "gh_compare": gh_compare,
    "gh_compare_synthetic": gh_compare_synthetic,
    "newest_windows": newest_windows,
    "window_export": window_export,
    "window_export_synthetic": window_export_synthetic,
    "route_questions": route_questions,
    "question_records": question_records,
    "answers": answers,
    "answer_facts": answer_facts,
    "answers_synthetic": answers_synthetic,
    "answer_rankings": answer_rankings,
    "answer_rankings_synthetic": answer_rankings_synthetic,
    "answer_questions": answer_questions,
    "answer_questions_synthetic": answer_questions_synthetic,
    "answer_records": answer_records,
    "stream_tumbling_avg_max": stream_tumbling_avg_max,
    "stream_tumbling_trimmed": stream_tumbling_trimmed,
    "stream_sliding_avg": stream_sliding_avg,
    "stream_late_rows": stream_late_rows,
    "stream_late_counts": stream_late_counts,
    "stream_upsert": stream_upsert,
    "stream_resume": stream_resume,
    "stream_table_and_feed": stream_table_and_feed,
    "feed_consumed": feed_consumed,
    "stream_processing_time": stream_processing_time,
}
