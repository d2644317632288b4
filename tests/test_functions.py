"""Golden cases of the column expressions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from verdance.functions import labels
from verdance.functions.alarm_rules import scored_reasons
from verdance.functions.values import abs_diff, text, trimmed_mean
from verdance.model import LABELS
from verdance.plans import facts, questions


@pytest.mark.parametrize(
    "values, expected",
    [([5.0], 5), ([5.0, 7.0], 6), ([3.0, 1.0, 9.0], 3), ([1.0, 9.0, 2.0, 100.0], 5.5), ([4.0, 4.0, 4.0], 4)],
)
def test_trimmed_mean_a3(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(trimmed_mean(F.col("v"))).first()[0] == pytest.approx(expected)


def test_trimmed_mean_properties(spark):
    rng = random.Random(7)
    groups = {g: [rng.randint(0, 500) for _ in range(rng.randint(1, 12))] for g in range(200)}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    got = spark.createDataFrame(rows, "g int, v long").groupBy("g").agg(trimmed_mean(F.col("v")).alias("m"))
    for g, m in got.collect():
        vs = sorted(groups[g])
        kept = vs if len(vs) <= 2 else vs[1:-1]
        assert m == pytest.approx(sum(kept) / len(kept))
        assert vs[0] <= m <= vs[-1]


@pytest.mark.parametrize("outlier", [1e14, 1e17, -1e17, 1e300, float("inf"), float("-inf")])
def test_trimmed_mean_trims_an_outlier_without_trace(spark, outlier):
    df = spark.createDataFrame([(v,) for v in (24.13, 25.37, 26.0, outlier)], "v double")
    expected = 25.685 if outlier > 0 else 24.75
    assert df.agg(trimmed_mean(F.col("v"))).first()[0] == expected


def test_trimmed_mean_of_outliers(spark):
    def mean(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(trimmed_mean(F.col("v"))).first()[0]

    inf = float("inf")
    assert mean(-1e300, 1.25, 2.5, 1e300) == 1.875
    assert mean(1e300) == 1e300 and mean(1.0, inf) == inf
    assert mean(1.0, 2.0, 1e17, 1e17) == pytest.approx(5e16)
    assert mean(1e17, 1e17, 1e17) == 1e17


def test_trimmed_mean_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(trimmed_mean(F.col("v"))).first()[0] is None


def test_labels_f1(spark):
    keys = ["gh_01", "GH_01", " gh_01 ", "1", "gh_02", "3", None, "", " \t\u3000", "gh_99", "大棚二", " gh_99 "]
    df = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    got = [r[0] for r in df.orderBy("i").select(labels.normalized(F.col("k"))).collect()]
    one, two, three = LABELS
    assert got == [one, one, one, one, two, three, None, None, None, "gh_99", two, "gh_99"]


def test_synthetic_labels_f2_f8_f9(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:00:05", "2024-01-01 00:00:10", "2024-01-01 00:00:19"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = df.select(labels.synthetic(F.col("t").cast("timestamp")), labels.synthetic_text(F.col("t"))).collect()
    assert [r[0] for r in got] == [LABELS[0], LABELS[1], LABELS[2], LABELS[0]]
    assert [r[1] for r in got] == [r[0] for r in got]
    odd = ["no time", "大棚x", "2024-01-01"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    got = [r[0] for r in df.select(labels.synthetic_text(F.col("t"))).collect()]
    assert got == [LABELS[sum(map(ord, t)) % 3] for t in odd]


def test_keys_f4(spark):
    got = spark.range(1).select(*[labels.key_of(F.lit(x)) for x in (*LABELS, "gh_77")]).first()
    assert list(got) == ["gh_01", "gh_02", "gh_03", "gh_77"]


def test_values_f7_f12(spark):
    got = spark.range(1).select(
        abs_diff(F.lit(1.0), F.lit(3.456)),
        abs_diff(F.lit(1.0), F.lit(None).cast("double")),
        text("%.1f", F.lit(2.0)),
        text("%.1f", F.lit(None).cast("double")),
    ).first()
    assert list(got) == [2.46, None, "2.0", None]


# light, hum, temp, previous temp, soil, recent hot windows
ALARMS = [
    ((95000.0, 20.0, 31.0, 26.0, 10.0, 3), [(90, "R1"), (85, "R2"), (80, "R3"), (75, "R4"), (70, "R5")]),
    ((60000.0, 30.0, 33.0, 30.0, 20.0, 3), [(70, "R5"), (65, "R2"), (55, "R1"), (55, "R3"), (55, "R4")]),
    ((None, 40.0, 31.0, None, None, 0), [(30, "R6")]),
    ((70000.0, 35.0, 31.0, 28.5, 25.0, 2), [(75, "R1"), (55, "R3")]),
    ((89999.0, 25.0, 31.0, 27.0, 15.0, 2), [(80, "R3"), (75, "R1"), (65, "R2"), (55, "R4")]),
]


@pytest.mark.parametrize("given, expected", ALARMS)
def test_alarm_rules_r1_to_r6(spark, given, expected):
    df = spark.createDataFrame([given], "light double, hum double, temp double, prev double, soil double, n long")
    got = df.select(scored_reasons(*[F.col(c) for c in ("temp", "hum", "soil", "light", "prev", "n")])).first()[0]
    assert [(r["score"], r["rule"]) for r in got] == expected
    assert all(r["reason"] and r["detail"] for r in got)


def test_alarm_texts(spark):
    df = spark.createDataFrame(
        [(95000.4, 20.0, 31.0, 26.0, 10.0, 3)], "light double, hum double, temp double, prev double, soil double, n long"
    )
    got = df.select(scored_reasons(*[F.col(c) for c in ("temp", "hum", "soil", "light", "prev", "n")])).first()[0]
    by_rule = {r["rule"]: r for r in got}
    assert by_rule["R1"]["reason"] == "正午日照过强" and "光照 95000 lux" in by_rule["R1"]["detail"]
    assert by_rule["R2"]["detail"].startswith("同窗口空气湿度仅 20.0%（阈值 35%）")
    assert by_rule["R3"]["reason"] == "温度飙升过快（Δ5.0℃/5s）"
    assert "有 3 个窗口温度超 30℃" in by_rule["R5"]["detail"]


QUESTIONS = [
    ("大棚一最近温度多少", "gh_latest", "大棚一", None),
    ("哪个大棚告警最多", "alarm_top", None, None),
    ("Spark 和 Flink 差异", "engine_diff", None, None),
    ("SPARK 与 flink 有什么区别", "engine_diff", None, None),
    ("为什么会高温", "alarm_reason", None, None),
    ("大棚一和大棚二对比", "gh_rank", None, None),
    ("各大棚平均温度排行", "gh_rank", None, None),
    ("大棚一与大棚二", "gh_compare", "大棚一", "大棚二"),
    ("三号棚和大棚 1", "gh_compare", "大棚一", "大棚三"),
    ("大棚2有多少次告警", "alarm_count", "大棚二", None),
    ("有多少次告警", "alarm_count", None, None),
    ("大棚一和我", "unknown", None, None),
    (" 你好 ", "unknown", None, None),
    ("\u3000大棚三现在多少度\n", "gh_latest", "大棚三", None),
    ("大和棚", "unknown", None, None),
]


def test_routing_q1_to_q3(spark):
    df = spark.createDataFrame([(i, q[0]) for i, q in enumerate(QUESTIONS)] + [(99, "  "), (98, None)], "q_id long, q string")
    got = {r["q_id"]: r for r in questions.route(df).collect()}
    assert len(got) == len(QUESTIONS) + 2
    for i, (q, intent, gh1, gh2) in enumerate(QUESTIONS):
        assert (got[i]["q"], got[i]["intent"], got[i]["gh1"], got[i]["gh2"]) == (q.strip(), intent, gh1, gh2)
    assert sorted(r["q_id"] for r in questions.empty(df).collect()) == [98, 99]
    told = {r["q_id"]: r for r in questions.records(df).collect()}
    assert {i for i, r in told.items() if r["error"]} == {98, 99}
    assert told[7]["answer_key"] == "gh_compare|大棚一|大棚二" and told[11]["answer_key"] is None


WINDOWS = "greenhouse_id string, win_start timestamp, win_end timestamp, avg_temp double, avg_humidity double, avg_soil_humidity double, max_light double"


def answered(spark, table, real=True, asked=None):
    known = facts.known_names(spark)
    asked = asked or [(i, q[0]) for i, q in enumerate(QUESTIONS)]
    rows = questions.answer(spark.createDataFrame(asked, "q_id long, q string"), facts.facts(table, real, known)).collect()
    assert len(rows) == len(asked)
    return {r["q_id"]: r for r in rows}


def test_answers_without_data(spark):
    got = answered(spark, spark.createDataFrame([], WINDOWS))
    assert {r["answer"] for r in got.values() if r["intent"] == "unknown"} == {questions.HELP}
    assert {r["answer"] for r in got.values() if r["intent"] in questions.LISTED} == {None}
    for r in got.values():
        if r["intent"] in ("gh_latest", "alarm_count"):
            assert r["answer"] == f"{r['gh1'] or 'all greenhouses'}: no " + ("data" if r["intent"] == "gh_latest" else "hot window")
        if r["intent"] == "gh_compare":
            assert r["answer"] == f"{r['gh1']}: no data; {r['gh2']}: no data"


def test_answers_name_greenhouses_without_windows(spark):
    at = dt.datetime(2024, 1, 1, 0, 0, 5)
    t = spark.createDataFrame([("gh_01", at, at, 25.0, 50.0, 40.0, 3000.0)], WINDOWS)
    asked = [(0, "大棚一最近温度多少"), (1, "大棚三最近温度多少"), (2, "大棚一与大棚二"), (3, "大棚三有多少次告警"), (4, "有多少次告警"), (5, " "), (6, None)]
    got = answered(spark, t, asked=asked)
    assert got[0]["answer"] == "大棚一 at 2024-01-01 00:00:05: temperature 25.0, humidity 50.0, soil 40.0, light 3000"
    assert got[1]["answer"] == "大棚三: no data"
    assert got[2]["answer"] == "大棚一: temperature 25.0, humidity 50.0, light 3000; 大棚二: no data"
    assert got[3]["answer"] == "大棚三: no hot window" and got[4]["answer"] == "all greenhouses: no hot window"
    assert got[5]["error"] == got[6]["error"] == "empty question" and got[5]["answer"] is None


def test_facts_of_many_greenhouses_with_odd_keys(spark):
    """Thousands of keys; null, blank and unknown ones; a key whose metrics are all null."""
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=5 * i)
    rows = [(f"site_{g}", at(i), at(i + 1), 20.0 + g % 13 + i, 50.0, 40.0, 100.0 * g) for g in range(2500) for i in range(2)]
    rows += [(k, at(9), at(10), 99.0, 1.0, 1.0, 1.0) for k in (None, "", "  ")]
    rows += [(" GH_02 ", at(3), at(4), 31.0, None, None, None), ("dark", at(3), at(4), None, None, None, None)]
    table = facts.facts(spark.createDataFrame(rows, WINDOWS), True, facts.known_names(spark))
    got = {r["greenhouse"]: r for r in table.collect()}
    assert len(got) == 2500 + 3 + 1 + 1  # sites, known names, dark, all
    assert got["site_12"]["hot_n"] == 2 and got["site_12"]["mean_temp"] == 32.5 and got["site_12"]["last_start"] == at(1)
    assert got["大棚二"]["hot_n"] == 1 and got["大棚二"]["last_avg_humidity"] is None and got["大棚一"]["windows"] == 0
    assert got["dark"]["mean_temp"] is None and got["dark"]["windows"] == 1
    assert got[None]["hot_n"] == 1 + sum(20.0 + g % 13 + i > 30 for g in range(2500) for i in range(2))
    ranks = facts.rankings(table)
    warm = [r["greenhouse"] for r in ranks.where("answer_key = 'gh_rank'").orderBy("sort_value", "greenhouse").collect() if r["temp"] is not None]
    assert len(warm) == 2501 and got[warm[0]]["mean_temp"] == 32.5


def test_facts_told_by_time(spark):
    """No real keys: hot windows cannot be told apart, rankings go by label, known names in order."""
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=5 * i)
    rows = [(at(i), at(i + 1), t, 50.0, 40.0, 100.0) for i, t in ((0, 31.0), (0, 35.0), (1, 20.0), (3, 40.0))]
    table = spark.createDataFrame(rows, WINDOWS.partition(", ")[2])
    by_time = facts.facts(table, False, facts.known_names(spark))
    got = {r["greenhouse"]: r for r in by_time.collect()}
    assert {r["mode"] for r in got.values()} == {"synthetic"}
    assert [got[g]["hot_n"] for g in ("大棚一", "大棚二", None)] == [3, 3, 3]
    assert [got[g]["ranked_hot"] for g in ("大棚一", "大棚二", "大棚三")] == [3, 0, 0]
    assert got["大棚一"]["mean_temp"] == round(106 / 3, 4) and got["大棚一"]["rank_temp"] == 36.5 and got["大棚三"]["rank_temp"] is None
    ranks = facts.rankings(by_time).where("answer_key = 'gh_rank'").orderBy("sort_value").collect()
    assert [r["greenhouse"] for r in ranks] == ["大棚一", "大棚二", "大棚三"]
    told = answered(spark, table, False, [(0, "大棚三最近温度多少"), (1, "大棚一最近温度多少")])
    assert told[0]["answer"] == "大棚三: no data" and told[1]["answer"].startswith("大棚一 at 2024-01-01 00:00:15: temperature 40.0")
