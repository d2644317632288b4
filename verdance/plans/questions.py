"""Questions to answers (Q1-Q5): route a table of questions, one answer for each from the facts;
all answers there are, as lines under the key that a question's record names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import intents, labels
from verdance.functions.values import text, time_of_day, time_text
from verdance.model import BLANKS, LABELS
from verdance.plans import reports

NO_DATA = "暂无数据"

HELP = "ask for the newest window of a greenhouse, two greenhouses, hot windows, rankings, the engines or a cause"

PARAMS = {
    "alarm_count": ("named", None),
    "gh_latest": ("named", None),
    "gh_compare": ("named", "second"),
}


def _stripped(c: str) -> Column:
    return F.trim(c, F.lit(BLANKS))


def route(questions: DataFrame) -> DataFrame:
    """(q_id, q) to (q_id, q, intent, gh1, gh2). A question without text is of the intent
    ``empty`` (Q5)."""
    q = F.col("q")
    found = (
        questions.select("q_id", F.coalesce(_stripped("q"), F.lit("")).alias("q"))
        .withColumns({"lowered": F.lower(q), "named": intents.first_greenhouse(q)})
        .withColumn("second", intents.first_greenhouse(q, F.col("named")))
        .withColumn(
            "intent",
            F.when(q == "", "empty").otherwise(intents.intent(q, F.col("lowered"), F.col("named"), F.col("second"))),
        )
    )

    def param(i: int) -> Column:
        return F.coalesce(
            *[F.when(F.col("intent") == k, F.col(v[i])) for k, v in PARAMS.items() if v[i]],
            F.lit(None).cast("string"),
        )

    return found.select("q_id", "q", "intent", param(0).alias("gh1"), param(1).alias("gh2"))


def records(questions: DataFrame) -> DataFrame:
    """Q5: one record per question, whatever the number of greenhouses: its intent, its
    parameters and the key under which ``answers`` holds its lines; a question without
    text is an error. ``record`` is the same as JSON."""
    routed = route(questions)
    key = F.when(~F.col("intent").isin("unknown", "empty"), F.concat_ws("|", "intent", "gh1", "gh2"))
    error = F.when(F.col("intent") == "empty", F.lit("empty question"))
    named = routed.select("q_id", "q", "intent", "gh1", "gh2", key.alias("answer_key"), error.alias("error"))
    return named.withColumn("record", F.to_json(F.struct("q_id", "q", "intent", "gh1", "gh2", "answer_key", "error")))


def empty(questions: DataFrame) -> DataFrame:
    """Q5: questions without text, which are errors."""
    return questions.where(F.coalesce(_stripped("q"), F.lit("")) == "")


#: Cells in which pairs of greenhouses meet, along each side.
CELLS = 8


def _line(intent: str, line: Column, gh1: Column | None = None, gh2: Column | None = None, order: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(intent).alias("intent"),
        (none if gh1 is None else gh1).alias("gh1"),
        (none if gh2 is None else gh2).alias("gh2"),
        (F.lit(0.0) if order is None else order.cast("double")).alias("sort_value"),
        F.coalesce(line, F.lit(NO_DATA)).alias("line"),
    )


def _rows(df: DataFrame, *lines: Column) -> DataFrame:
    """The lines that apply to each row, each as a row; null lines are left out."""
    return df.select(F.inline(F.array_compact(F.array(*lines))))


def _counted(who: Column) -> Column:
    told = text("%s：%d 次高温告警，平均温度 %.1f℃，最高 %.1f℃", who, F.col("hot_n"), F.round("hot_mean", 1), F.round("hot_top", 1))
    return F.when(F.col("hot_n") > 0, told).otherwise(F.concat(who, F.lit("：0 次高温告警")))


def _compared(per: DataFrame) -> DataFrame:
    """Every two greenhouses, the earlier key first. They meet in a square of cells, so that
    many greenhouses are many tasks."""
    side = per.select("greenhouse", labels.key_of(F.col("greenhouse")).alias("k"), F.round("t", 4).alias("t"))
    side = side.withColumn("cell", F.pmod(F.xxhash64("greenhouse"), F.lit(CELLS)))
    every = F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1)).cast("array<long>"))
    a = side.withColumnsRenamed({"cell": "row"}).withColumn("column", every).alias("a")
    b = side.withColumnsRenamed({"cell": "column"}).withColumn("row", every).alias("b")
    met = a.join(b, (F.col("a.row") == F.col("b.row")) & (F.col("a.column") == F.col("b.column")) & (F.col("a.k") < F.col("b.k")))
    one, two, d = F.col("a.greenhouse"), F.col("b.greenhouse"), F.round(F.col("a.t") - F.col("b.t"), 4)
    verdict = F.when(d > 0, F.lit("高于")).otherwise(F.lit("低于"))
    return _rows(met, _line("gh_compare", text("%s %s %s，相差 %.1f℃", one, verdict, two, F.round(F.abs(d), 1)), one, two))


def _environment_lines(keyed: DataFrame, hot_above: float) -> DataFrame:
    """Counts, rankings and comparisons of all greenhouses from one grouping; its rows are
    grouped once more for the total, which is there without a window too."""
    temp = F.col("avg_temp")
    hot = temp > hot_above
    per = keyed.groupBy("greenhouse").agg(
        F.count_if(hot).alias("hot_n"),
        F.sum(F.when(hot, temp)).alias("hot_sum"),
        F.max(F.when(hot, temp)).alias("hot_top"),
        F.avg(temp).alias("t"),
        F.avg("avg_humidity").alias("h"),
        F.avg("max_light").alias("l"),
        F.max("win_start").alias("last"),
    )
    absent = {g: F.col(f"named_{i}") == 0 for i, g in enumerate(LABELS)}
    total = per.agg(
        F.coalesce(F.sum("hot_n"), F.lit(0)).alias("hot_n"),
        F.sum("hot_sum").alias("hot_sum"),
        F.max("hot_top").alias("hot_top"),
        *[F.count_if(F.col("greenhouse") == g).alias(f"named_{i}") for i, g in enumerate(LABELS)],
    )
    mean = F.try_divide("hot_sum", "hot_n")
    who, n, env = F.col("greenhouse"), F.col("hot_n"), text("均温 %.1f℃ · 均湿 %.1f%% · 光照 %.0f lux", F.round("t", 1), F.round("h", 1), F.round("l", 0))
    each = [
        _line("alarm_count", _counted(who), who),
        F.when(n > 0, _line("alarm_top", text("%s：%d 次高温告警", who, n), order=-n)),
        _line("gh_rank", F.concat(who, F.lit("（截止 "), time_of_day(F.col("last")), F.lit("）: "), env), order=-F.round("t", 4)),
    ]
    every = [_line("alarm_count", _counted(F.lit("所有大棚")))]
    # labels a question can name of which there is no window
    for i, (g, none) in enumerate(absent.items()):
        every.append(F.when(none, _line("alarm_count", F.lit(f"{g}：0 次高温告警"), F.lit(g))))
        every.append(F.when(none, _line("gh_latest", F.lit(None).cast("string"), F.lit(g))))
        for b in LABELS[i + 1 :]:
            every.append(F.when(none | absent[b], _line("gh_compare", F.lit(None).cast("string"), F.lit(g), F.lit(b))))
    told = [_rows(df.withColumn("hot_mean", mean), *lines) for df, lines in ((per, each), (total, every))]
    return told[0].unionByName(told[1]).unionByName(_compared(per))


def _latest_lines(keyed: DataFrame) -> DataFrame:
    who = F.col("greenhouse")
    values = text(
        "温度 %.1f℃ · 湿度 %.1f%% · 土壤湿度 %.1f%% · 光照 %.0f lux",
        F.round("avg_temp", 1),
        F.round("avg_humidity", 1),
        F.round("avg_soil_humidity", 1),
        F.round("max_light", 0),
    )
    told = F.concat(who, F.lit(" 最新窗口（"), time_text(F.col("win_start")), F.lit("）: "), values)
    return _rows(reports.gh_latest(keyed), _line("gh_latest", told, who))


def answers(windows: DataFrame, diff: DataFrame | None = None, alarm: DataFrame | None = None, hot_above: float = reports.HOT) -> DataFrame:
    """Q4: every answer the questions can ask for, as (intent, gh1, gh2, sort_value, line).

    ``windows`` is labelled by real keys. Rankings are one row per greenhouse with ``sort_value``
    ascending in rank order. ``diff`` and ``alarm`` are the results of ``compare.engine_diff`` and
    ``alarms.latest_alarm``.
    """
    keyed = windows.where(F.col("greenhouse").isNotNull())
    parts = [_environment_lines(keyed, hot_above), _latest_lines(keyed)]
    if diff is not None:
        state = [F.when(F.col(f"{s}_alive"), F.lit("运行中")).otherwise(F.lit("离线")) for s in ("left", "right")]
        told = text(
            "Spark: %d 窗口 · %s；Flink: %d 窗口 · %s；对齐窗口: %d；平均温度偏差: %.2f℃",
            F.col("left_windows"),
            state[0],
            F.col("right_windows"),
            state[1],
            F.col("pairs"),
            F.coalesce(F.round("avg_diff_temp", 2), F.lit(0.0)),
        )
        parts.append(_rows(diff, _line("engine_diff", told)))
    if alarm is not None:
        others = F.transform("secondary", lambda r: F.format_string("次要：%s（%d%%）", r["reason"], r["score"]))
        main = F.format_string("%s 主因：%s（置信度 %d%%）", F.col("greenhouse"), F.col("primary.reason"), F.col("confidence"))
        parts.append(_rows(alarm, _line("alarm_reason", F.concat_ws("；", F.array(main, F.col("primary.detail")), others))))
    return reduce(DataFrame.unionByName, parts)


#: Intents whose answer is a list, which ``facts.rankings`` holds once under this key.
LISTED = ("alarm_top", "gh_rank")


def _environment(name: Column, side: str) -> Column:
    c = lambda n: F.col(f"{side}.mean_{n}")
    told = text("%s: temperature %.1f, humidity %.1f, light %.0f", name, F.round(c("temp"), 1), F.round(c("humidity"), 1), F.round(c("light"), 0))
    return F.coalesce(told, F.concat(name, F.lit(": no data")))


def _told() -> dict[str, Column]:
    """The answer of each intent that one or two rows of facts give (``a``, ``b``)."""
    one, two = F.col("gh1"), F.col("gh2")
    who = F.coalesce(one, F.lit("all greenhouses"))
    hot = text("%s: %d hot windows, mean %.1f, highest %.1f", who, F.col("a.hot_n"), F.round("a.hot_mean", 1), F.round("a.hot_max", 1))
    last = text(
        "%s at %s: temperature %.1f, humidity %.1f, soil %.1f, light %.0f",
        one,
        time_text(F.col("a.last_start")),
        F.round("a.last_avg_temp", 1),
        F.round("a.last_avg_humidity", 1),
        F.round("a.last_avg_soil_humidity", 1),
        F.round("a.last_max_light", 0),
    )
    apart = text("difference %.1f", F.round(F.col("a.mean_temp") - F.col("b.mean_temp"), 1))
    return {
        "alarm_count": F.coalesce(F.when(F.col("a.hot_n") > 0, hot), F.concat(who, F.lit(": no hot window"))),
        "gh_latest": F.coalesce(last, F.concat(one, F.lit(": no data"))),
        "gh_compare": F.concat_ws("; ", _environment(one, "a"), _environment(two, "b"), apart),
    }


def engines_told(diff: DataFrame) -> Column:
    """Text of the one row of ``compare.engine_diff``."""
    up = [F.when(F.col(f"{s}_alive"), "up").otherwise("down") for s in ("left", "right")]
    told = text(
        "left %d windows (%s), right %d windows (%s), %d pairs, mean difference %.2f",
        F.col("left_windows"),
        up[0],
        F.col("right_windows"),
        up[1],
        F.col("pairs"),
        F.coalesce(F.round("avg_diff_temp", 2), F.lit(0.0)),
    )
    return diff.select(told.alias("told")).scalar()


def alarm_told(alarm: DataFrame, others: int = 2) -> Column:
    """Text of the one row of ``alarms.latest_alarm``: the main cause and at most ``others`` more
    (T4)."""
    cause = lambda r: F.format_string("%s %d%%", r["reason"], r["score"])
    main = F.format_string("%s at %.1f: %s, %s", F.col("greenhouse"), F.round("avg_temp", 1), cause(F.col("primary")), F.col("primary.detail"))
    told = F.concat_ws("; ", F.array(main), F.transform(F.slice("secondary", 1, others), cause))
    return alarm.select(told.alias("told")).scalar()


def answer(questions: DataFrame, facts: DataFrame, diff: DataFrame | None = None, alarm: DataFrame | None = None) -> DataFrame:
    """Q5: (q_id, q, intent, gh1, gh2, mode, answer_key, answer, error), one row per question.

    ``answer`` is a text; questions for a ranking have an ``answer_key`` instead, under which
    ``facts.rankings`` holds the list once. Questions may be many and fall on few greenhouses: each
    meets at most two rows of facts, and the adaptive planner broadcasts those by measured size or
    splits the skewed side.
    """
    routed = route(questions).alias("r")
    one, two = facts.alias("a"), facts.where(F.col("greenhouse").isNotNull()).alias("b")
    met = routed.join(one, F.col("r.gh1").eqNullSafe(F.col("a.greenhouse")), "left")
    met = met.join(two, F.col("r.gh2") == F.col("b.greenhouse"), "left")
    intent = F.col("intent")
    told = {**_told(), "unknown": F.lit(HELP)}
    told["engine_diff"] = F.lit("no data") if diff is None else F.coalesce(engines_told(diff), F.lit("no data"))
    told["alarm_reason"] = F.lit("no hot window") if alarm is None else F.coalesce(alarm_told(alarm), F.lit("no hot window"))
    mode = facts.agg(F.first("mode").alias("mode")).scalar()
    return met.select(
        "q_id",
        "q",
        "intent",
        "gh1",
        "gh2",
        mode.alias("mode"),
        F.when(intent.isin(*LISTED), intent).alias("answer_key"),
        F.coalesce(*[F.when(intent == k, v) for k, v in told.items()]).alias("answer"),
        F.when(intent == "empty", F.lit("empty question")).alias("error"),
    )


def answer_records(answered: DataFrame) -> DataFrame:
    """Q5: each question with its answer as one JSON record."""
    return answered.select("q_id", F.to_json(F.struct("q_id", "q", "intent", "mode", "answer_key", "answer", "error")).alias("record"))
