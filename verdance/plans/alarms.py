"""Alarm attribution (R1-R8, L1, L4, L11, T1, J6): every hot window with its causes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions.alarm_rules import scored_reasons
from verdance.functions.labels import label, may_be
from verdance.functions.values import time_text
from verdance.model import STATS, AlarmSpec
from verdance.operators.align import SIDES, paired
from verdance.operators.history import at_window, look_back
from verdance.operators.tables import with_key_column


def _named(table: DataFrame, window_seconds: int) -> DataFrame:
    t = with_key_column(table)
    return t.withColumn("greenhouse", label(F.col("greenhouse_id"), F.col("win_start"), window_seconds))


def _sides(rows: DataFrame) -> list[str]:
    return [s for s in SIDES if s in rows.columns]


def history(
    primary: DataFrame, backup: DataFrame | None = None, spec: AlarmSpec = AlarmSpec(), window_seconds: int = 5
) -> DataFrame:
    """Windows of both tables (``left``, ``right``) with previous window and recent hot
    count (R7)."""
    second = None if backup is None else _named(backup, window_seconds)
    rows = paired(_named(primary, window_seconds), second)
    return look_back(rows, spec, _sides(rows))


def _attributed(rows: DataFrame, window: Column, spec: AlarmSpec) -> DataFrame:
    """R8 for rows whose chosen window is hot."""
    hot = rows.withColumn("_w", window).where(F.col("_w.avg_temp") > spec.hot_above)
    scored = hot.withColumn(
        "reasons",
        scored_reasons(
            F.col("_w.avg_temp"),
            F.col("_w.avg_humidity"),
            F.col("_w.avg_soil_humidity"),
            F.col("_w.max_light"),
            F.col("prev.avg_temp"),
            F.col("recent_hot"),
        ),
    )
    return scored.select(
        "greenhouse",
        "win_start",
        F.col("_w.win_end").alias("win_end"),
        *[F.col(f"_w.{s}").alias(s) for s in STATS],
        "prev",
        "recent_hot",
        "reasons",
        F.element_at("reasons", 1).alias("primary"),
        F.slice("reasons", 2, F.greatest(F.size("reasons") - 1, F.lit(0))).alias("secondary"),
        F.element_at("reasons", 1)["score"].alias("confidence"),
    )


def alarms(rows: DataFrame, spec: AlarmSpec = AlarmSpec()) -> DataFrame:
    """Attribution of every hot window of ``history``: a window counts from the
    primary table, or from the backup where the primary lacks it."""
    return _attributed(rows, F.coalesce(*_sides(rows)), spec)


def _of(table: DataFrame, greenhouse: str | None, window_seconds: int) -> DataFrame:
    """The table with labels, of one greenhouse if named: what can be told from the key reaches
    the scan, the label is computed for the rest."""
    if greenhouse is None:
        return _named(table, window_seconds)
    t = with_key_column(table)
    t = t.where(may_be(F.col("greenhouse_id"), greenhouse)) if "greenhouse_id" in table.columns else t
    return _named(t, window_seconds).where(F.col("greenhouse") == greenhouse)


def _time(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def _before(table: DataFrame, start: int, spec: AlarmSpec) -> Iterator[DataFrame]:
    """The windows before ``start`` (microseconds) in slices that reach twice as far back each
    time, until nothing older is left. Only the slice is read, and one older row."""
    back = spec.bucket_seconds * 1_000_000
    at = F.col("win_start")
    while True:
        yield table.where((at >= _time(start - back)) & (at < _time(start)))
        if table.where(at < _time(start - back)).select("win_start").isEmpty():
            return
        back *= 2


def _near(
    table: DataFrame, start: int, needed: DataFrame, spec: AlarmSpec, window_seconds: int, greenhouse: str | None
) -> DataFrame:
    """The rows that attributing the windows at ``start`` takes: those of the look-back, and the
    previous window of each greenhouse in ``needed``. How far back that is, a search finds from the
    key and start columns, slice by slice until every greenhouse has one; older rows are not read."""
    at = F.col("win_start")
    recent = start - spec.lookback_seconds * 1_000_000
    lowest, lasts = recent, None
    for slice_ in _before(table, start, spec):
        lasts = _of(slice_, greenhouse, window_seconds).groupBy("greenhouse").agg(F.max(at).alias("last"))
        met = needed.join(lasts, "greenhouse", "left")
        found = met.agg(F.count_if(F.col("last").isNull()).alias("missing"), F.unix_micros(F.min("last")).alias("lowest")).first()
        lowest = recent if found["lowest"] is None else min(recent, found["lowest"])
        if not found["missing"]:
            break
    rows = _of(table.where((at >= _time(lowest)) & (at <= _time(start))), greenhouse, window_seconds)
    if lowest == recent:
        return rows
    # some previous windows lie before the look-back: of those times these rows only
    kept = rows.join(lasts, "greenhouse", "left").where((at >= _time(recent)) | (at == F.col("last")))
    return kept.select(*rows.columns)


def _at(
    primary: DataFrame,
    backup: DataFrame | None,
    start: int,
    spec: AlarmSpec,
    window_seconds: int,
    greenhouse: str | None,
) -> DataFrame:
    """Windows that start at one time (microseconds), with their look-back."""
    both = [primary] if backup is None else [primary, backup]
    here = [_of(t.where(F.col("win_start") == _time(start)), greenhouse, window_seconds).select("greenhouse") for t in both]
    needed = reduce(DataFrame.unionByName, here).distinct()
    rows = paired(*[_near(t, start, needed, spec, window_seconds, greenhouse) for t in both])
    return at_window(rows, _time(start), spec, _sides(rows))


def alarms_at(
    primary: DataFrame,
    backup: DataFrame | None,
    win_start: str | Column,
    spec: AlarmSpec = AlarmSpec(),
    window_seconds: int = 5,
    greenhouse: str | None = None,
) -> DataFrame:
    """Given-window mode (L4): attribution of the hot windows that start at one time,
    in all greenhouses or one. Looks for the previous windows when it is called."""
    start = F.lit(win_start) if isinstance(win_start, str) else win_start
    micros = primary.sparkSession.range(1).select(F.unix_micros(start.cast("timestamp"))).first()[0]
    if micros is None:  # no such time: no window
        primary, micros = primary.where("false"), 0
        backup = None if backup is None else backup.where("false")
    return alarms(_at(primary, backup, micros, spec, window_seconds, greenhouse), spec)


def _newest_hot(table: DataFrame, spec: AlarmSpec, window_seconds: int, greenhouse: str | None) -> tuple[int, str] | None:
    """Start (microseconds) and greenhouse of the newest hot window: the newest start is found from
    one column, then slices are read from there back until one has a hot window."""
    last = table.agg(F.unix_micros(F.max("win_start"))).first()[0]
    if last is None:
        return None
    for slice_ in _before(table, last + 1, spec):
        windows = _of(slice_, greenhouse, window_seconds).groupBy("greenhouse", "win_start").agg(F.avg("avg_temp").alias("t"))
        newest = windows.where(F.col("t") > spec.hot_above).orderBy(F.desc("win_start"), "greenhouse")
        found = newest.select(F.unix_micros("win_start").alias("at"), "greenhouse").first()
        if found is not None:
            return found["at"], found["greenhouse"]
    return None


def latest_alarm(
    primary: DataFrame,
    backup: DataFrame | None = None,
    spec: AlarmSpec = AlarmSpec(),
    window_seconds: int = 5,
    greenhouse: str | None = None,
) -> DataFrame:
    """The newest hot window (T1), of one greenhouse if named: from the primary table, or from the
    backup if the primary has no hot window at all (J6); the backup is searched only then. The
    search runs when this is called."""
    found, source = _newest_hot(primary, spec, window_seconds, greenhouse), 0
    if found is None and backup is not None:
        found, source = _newest_hot(backup, spec, window_seconds, greenhouse), 1
    if found is None:
        none = _at(primary.where("false"), None if backup is None else backup.where("false"), 0, spec, window_seconds, greenhouse)
        return alarms(none, spec)
    rows = _at(primary, backup, found[0], spec, window_seconds, found[1])
    return _attributed(rows, F.col(_sides(rows)[source]), spec)


def reason_rows(attributed: DataFrame) -> DataFrame:
    """One row per alarm and cause, in rank order (T5). There is always a cause; ``outer``
    spares the filter for empty arrays, which would score every alarm twice."""
    return attributed.select(
        "greenhouse", "win_start", "avg_temp", "recent_hot", F.posexplode_outer("reasons").alias("pos", "r")
    ).select("greenhouse", "win_start", "avg_temp", "recent_hot", (F.col("pos") + 1).alias("rank"), "r.*")


def payload(attributed: DataFrame) -> DataFrame:
    """One JSON object per alarm."""
    window = F.struct(
        F.col("greenhouse").alias("gh"),
        F.col("avg_temp").alias("temp"),
        F.col("avg_humidity").alias("hum"),
        F.col("avg_soil_humidity").alias("soil"),
        F.col("max_light").alias("light"),
        time_text(F.col("win_start")).alias("win_start"),
        time_text(F.col("win_end")).alias("win_end"),
        F.col("recent_hot").alias("recent_high_count"),
    )
    before = F.when(
        F.col("prev").isNotNull(),
        F.struct(
            F.col("prev.avg_temp").alias("temp"),
            F.col("prev.avg_humidity").alias("hum"),
            F.col("prev.avg_soil_humidity").alias("soil"),
            F.col("prev.max_light").alias("light"),
            time_text(F.col("prev.win_start")).alias("win_start"),
        ),
    )

    def brief(r: Column) -> Column:
        return F.struct(r["score"].alias("score"), r["reason"].alias("reason"), r["detail"].alias("detail"))

    body = F.struct(
        F.lit(True).alias("ok"),
        window.alias("window"),
        before.alias("prev_window"),
        F.transform("reasons", brief).alias("reasons"),
        brief(F.col("primary")).alias("primary"),
        F.transform("secondary", brief).alias("secondary"),
        "confidence",
    )
    return attributed.select("greenhouse", "win_start", F.to_json(body).alias("value"))
