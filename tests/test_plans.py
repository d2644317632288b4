"""Shape of the physical plans: what must hold whatever the size of the data."""

import os
import re

import pytest

from verdance.catalog import frames as fr
from verdance.catalog.queries import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan(df, run=False):
    qe = df._jdf.queryExecution()
    if run:
        df.collect()
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python_no_unbounded_sort_group(spark, sf_dir, name):
    """A window function over a greenhouse's rows is cut by time bucket; over whole
    greenhouses only the rows that stand for a bucket each are sorted."""
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text
    for spec in re.findall(r"windowspecdefinition\((.*?) ASC NULLS", text):
        assert "_bucket" in spec


def test_scan_reads_needed_columns_only(spark, sf_dir):
    for name in ("tumbling_avg_max", "tumbling_trimmed_mean", "alarm_reasons", "engine_align"):
        schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan(QUERIES[name](spark, sf_dir))))
        assert schemas == {"event_id:bigint,ts:timestamp_ntz,user_id:bigint"}
    (keys,) = set(re.findall(r"ReadSchema: struct<(.*?)>", plan(QUERIES["key_counts"](spark, sf_dir))))
    assert keys == "ts:timestamp_ntz,user_id:bigint"


@pytest.fixture
def whole_plans(spark):
    """Plan texts name all filters of a scan, however long."""
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    yield
    spark.conf.set(name, before)


def test_filters_reach_the_scan_of_a_stored_table(spark, sf_dir, tmp_path, whole_plans):
    from verdance.plans import alarms, reports
    from verdance.sources import tables

    fr.left(spark, sf_dir).write.parquet(f"{tmp_path}/stats")
    stored = tables.read_parquet(spark, f"{tmp_path}/stats")
    text = reports.alarm_count(stored, "大棚二")._jdf.queryExecution().toString()
    assert "GreaterThan(avg_temp,30.0)" in text and "EqualTo(greenhouse_id" in text
    text = alarms.alarms_at(stored, None, "2024-01-02 00:00:00")._jdf.queryExecution().toString()
    assert "LessThanOrEqual(win_start" in text


def test_stored_tables_have_statistics_that_prune(spark, sf_dir, tmp_path):
    """Each file covers a range of starts of its own, so a filter on time skips files."""
    import glob

    import pyarrow.parquet as pq

    from verdance.sources import tables

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.store(fr.left(spark, sf_dir), f"{tmp_path}/t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spans = []
    for path in glob.glob(f"{tmp_path}/t/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            column = next(c for c in map(meta.row_group(g).column, range(meta.num_columns)) if c.path_in_schema == "win_start")
            spans.append((column.statistics.min, column.statistics.max))
    spans.sort()
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_bucketed_tables_are_compared_where_they_lie(spark, sf_dir, tmp_path):
    """No shuffle but those of the report's order and of windows that found no partner."""
    from verdance.operators.align import align, paired
    from verdance.plans import compare
    from verdance.sources import tables

    plain = fr.labelled(fr.left(spark, sf_dir)), fr.unkeyed(fr.right(spark, sf_dir), "gh_02")
    l, r = (tables.store_bucketed(t, f"{tmp_path}/{n}", 6) for t, n in zip(plain, "lr"))
    assert l.columns == plain[0].columns
    assert "Exchange" not in plan(paired(l, r, 2))
    assert "Exchange" not in plan(l.groupBy("greenhouse", "win_start").count())
    text = plan(compare.compare_export(l, r), run=True)
    assert not re.findall(r"Exchange hashpartitioning\(greenhouse", text) and "Bucketed: true" in text

    def rows(df):
        return sorted(map(repr, df.collect()))

    assert rows(align(l, r)) == rows(align(*plain)) != []
    # unlike layouts are still compared rightly, at the price of a shuffle
    other = tables.store_bucketed(plain[1], f"{tmp_path}/o", 3)
    assert "Exchange" in plan(paired(l, other, 2))
    assert rows(align(l, other)) == rows(align(*plain))
    # repeats and an empty table
    twice = tables.store_bucketed(plain[0].unionByName(plain[0]), f"{tmp_path}/twice", 6)
    assert rows(align(twice, r)) == rows(align(*plain))
    none = tables.store_bucketed(plain[1].where("false"), f"{tmp_path}/none", 6)
    assert align(l, none).collect() == []


def test_run_tables_go_with_the_run_dirs(spark, sf_dir, monkeypatch):
    from verdance import session

    monkeypatch.setattr(session, "_made", [])
    monkeypatch.setattr(session, "_tables", [])
    fr.bucketed(fr.labelled(fr.left(spark, sf_dir)), "gone")
    ((name,), (path,)) = session._tables, session._made
    assert spark.catalog.tableExists(name)
    session.remove_run_dirs(spark)
    assert not spark.catalog.tableExists(name) and session._tables == session._made == []
    assert not os.path.exists(path)


STORING = {"engine_align_one", "engine_diff", "compare_export", "compare_payload", "answers", "answer_questions"}
STORING |= {"answers_synthetic", "answer_rankings", "answer_rankings_synthetic", "answer_questions_synthetic", "answer_records", "feed_consumed"}
STORING |= {"alarm_at_window", "alarm_latest", "alarm_latest_one"}


@pytest.mark.parametrize("name", [n for n in BATCH if n not in STORING])
def test_building_starts_no_job(spark, sf_dir, name):
    """Only queries that store a shared window table work while they are built."""
    tracker = spark.sparkContext.statusTracker()
    group = f"building {name}"
    spark.sparkContext.setJobGroup(group, group)
    QUERIES[name](spark, sf_dir)
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["tumbling_avg_max", "tumbling_trimmed_mean", "dedup_windows", "engine_align"])
def test_partial_aggregation_before_each_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for below in re.findall(r"Exchange hashpartitioning.*\n.*", text):
        assert "partial_" in below or "Sort" in below or "WindowGroupLimit" in below


@pytest.mark.parametrize(
    "name", ["tumbling_avg_max", "tumbling_trimmed_mean", "sliding_avg", "alarm_reasons", "alarm_at_window", "alarm_latest", "gh_rank"]
    + [n for n in BATCH if n.startswith(("engine_align", "gh_latest"))],
)
def test_hash_aggregation(spark, sf_dir, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["engine_align", "engine_align_null_left", "engine_align_null_right", "alarm_reasons"])
def test_window_pairs_are_shuffled_once(spark, sf_dir, name):
    """Further uses of the grouped windows read the first one's shuffle. Where every window has
    its key the fallback turns out empty while the query runs, and goes."""
    text = plan(QUERIES[name](spark, sf_dir), run=True)
    fresh = re.findall(r"\+- Exchange hashpartitioning\(greenhouse#\d+, win_start", text)
    assert len(fresh) == 1
    assert ("EmptyRelation" if name == "engine_align" else "ReusedExchange") in text


def test_each_message_is_parsed_once(spark, sf_dir):
    from verdance.operators import windowing
    from verdance.sources import readings as src

    raw = fr.messages(spark, sf_dir).select("value")
    raw = spark.createDataFrame(raw.limit(5).collect(), "value string")
    for parsed in (src.parse(raw), src.accepted(src.parse_strict(raw)), src.rejected(src.parse_strict(raw))):
        assert plan(parsed).count("from_json") == 1
        if "event_time" in parsed.columns:
            assert plan(windowing.tumbling_avg_max(parsed)).count("from_json") == 1
