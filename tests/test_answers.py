"""Answer lines: every intent has its lines, every two greenhouses are compared."""

import datetime as dt
import itertools

import duckdb

from verdance.catalog.oracle import ORACLE
from verdance.catalog.queries import QUERIES
from verdance.plans import questions

WINDOWS = "greenhouse string, win_start timestamp, win_end timestamp, avg_temp double, avg_humidity double, avg_soil_humidity double, max_light double"
INTENTS = {"alarm_count", "alarm_top", "gh_rank", "gh_latest", "gh_compare", "engine_diff", "alarm_reason"}


def at(i):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=5 * i)


def lines(df):
    rows = df.collect()
    got = {(r["intent"], r["gh1"], r["gh2"]): r["line"] for r in rows if r["intent"] not in questions.LISTED}
    assert len(got) == sum(r["intent"] not in questions.LISTED for r in rows)
    return got


def test_registered_answers_cover_every_intent(spark, tmp_path):
    """Of both engines' windows: also their comparison and the latest alarm's causes."""
    rows = [(i, ("view", "click", "error")[i % 3], dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), i % 4) for i in range(900)]
    spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz, user_id long").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    df = QUERIES["answers"](spark, str(tmp_path))
    got = sorted(map(repr, map(tuple, df.collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(map(repr, con.execute(ORACLE["answers"]).fetchall()))
    assert {r["intent"] for r in df.collect()} == INTENTS


def test_every_two_of_many_greenhouses_are_compared(spark):
    names = ["大棚一", "大棚二", "大棚三"] + [f"site_{i:02}" for i in range(20)]
    rows = [(g, at(i), at(i + 1), 20.0 + n + i, 50.0, 40.0, 100.0) for n, g in enumerate(names) for i in range(2)]
    got = lines(questions.answers(spark.createDataFrame(rows, WINDOWS)))
    assert {k[1:] for k in got if k[0] == "gh_compare"} == set(itertools.combinations(names, 2))
    assert got[("gh_compare", "大棚一", "site_19")] == "大棚一 低于 site_19，相差 22.0℃"
    assert got[("alarm_count", "site_19", None)] == "site_19：2 次高温告警，平均温度 42.5℃，最高 43.0℃"
    hot = [20.0 + n + i for n in range(23) for i in range(2) if n + i > 10]
    assert got[("alarm_count", None, None)] == f"所有大棚：{len(hot)} 次高温告警，平均温度 {sum(hot) / len(hot):.1f}℃，最高 43.0℃"


def test_answer_lines_name_greenhouses_without_windows(spark):
    rows = [("大棚一", at(1), at(2), 25.0, 50.0, 40.0, 3000.0), ("大棚二", at(1), at(2), None, None, None, None), (None, at(1), at(2), 99.0, 1.0, 1.0, 1.0)]
    got = lines(questions.answers(spark.createDataFrame(rows, WINDOWS)))
    assert got[("alarm_count", None, None)] == "所有大棚：0 次高温告警" and got[("alarm_count", "大棚三", None)] == "大棚三：0 次高温告警"
    assert got[("gh_latest", "大棚一", None)].startswith("大棚一 最新窗口（2024-01-01 00:00:05）: 温度 25.0℃")
    assert got[("gh_latest", "大棚三", None)] == got[("gh_compare", "大棚一", "大棚三")] == got[("gh_compare", "大棚一", "大棚二")] == questions.NO_DATA
    none = lines(questions.answers(spark.createDataFrame([], WINDOWS)))
    assert none[("alarm_count", None, None)] == "所有大棚：0 次高温告警" and len(none) == 1 + 3 + 3 + 3
