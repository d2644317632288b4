"""Engine comparison reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions.values import time_text
from verdance.model import COMPARE_HEADER, SHORT
from verdance.operators.align import align
from verdance.operators.tables import keyed_only, labelled, latest_windows

ALIVE_SECONDS = 120


def load_windows(
    table: DataFrame, real: bool | Column = True, newest: int | None = None, window_seconds: int = 5
) -> DataFrame:
    """A window table in comparison form: rows without a key dropped where keys are
    real, labelled, and cut to the newest distinct windows when asked (T2)."""
    rows = labelled(keyed_only(table, real), real, window_seconds)
    return rows if newest is None else latest_windows(rows, newest)


def engine_stats(table: DataFrame, as_of: Column, alive_seconds: int = ALIVE_SECONDS) -> DataFrame:
    """A5: distinct windows, last window end, and whether that is recent."""
    return table.agg(F.countDistinct("win_start").alias("windows"), F.max("win_end").alias("last")).select(
        "windows",
        "last",
        F.coalesce(
            F.unix_micros(as_of) - F.unix_micros("last") < alive_seconds * 1_000_000, F.lit(False)
        ).alias("alive"),
    )


def compare_report(
    left: DataFrame, right: DataFrame, newest: int | None = None, max_n: int | None = None, greenhouse: str | None = None
) -> DataFrame:
    """Aligned pairs in ascending time, the newest only if asked for. Inputs are labelled tables."""
    if newest is not None:
        left, right = (latest_windows(t, newest) for t in (left, right))
    return align(left, right, max_n, greenhouse).orderBy("win_start", "greenhouse")


def compare_export(left: DataFrame, right: DataFrame, newest: int | None = None) -> DataFrame:
    """K6: the comparison as a report table, times as text, localized header."""
    pairs = compare_report(left, right, newest, newest)
    cols = [F.coalesce("greenhouse", F.lit("")), time_text(F.col("win_start")), time_text(F.col("win_end"))]
    for name in SHORT.values():
        cols += [F.col(f"{p}_{name}") for p in ("left", "right", "diff")]
    return pairs.select(*[c.alias(h) for c, h in zip(cols, COMPARE_HEADER)])


def engine_diff(
    left: DataFrame,
    right: DataFrame,
    as_of: Column,
    newest: int | None = None,
    digits: int = 4,
    alive_seconds: int = ALIVE_SECONDS,
) -> DataFrame:
    """Number of aligned pairs, mean temperature difference, health of both sides."""
    aligned = align(left, right) if newest is None else compare_report(left, right, newest, newest)
    pairs = aligned.agg(
        F.count("*").alias("pairs"), F.round(F.avg("diff_temp"), digits).alias("avg_diff_temp")
    )
    health = [
        engine_stats(t, as_of, alive_seconds).select(F.struct("windows", "last", "alive").alias("h")).scalar()
        for t in (left, right)
    ]
    packed = pairs.select("*", health[0].alias("l"), health[1].alias("r"))
    return packed.select(
        F.col("l.windows").alias("left_windows"),
        F.col("l.alive").alias("left_alive"),
        F.col("r.windows").alias("right_windows"),
        F.col("r.alive").alias("right_alive"),
        "pairs",
        "avg_diff_temp",
    )


def compare_payload(
    pairs: DataFrame, left_stats: DataFrame, right_stats: DataFrame, greenhouse: str | None = None
) -> DataFrame:
    """Comparison as one JSON object per aligned pair, health rows first. Rows
    stay separate so that a long report is written in parallel. ``greenhouse`` keeps its
    pairs only."""
    if greenhouse is not None:
        pairs = pairs.where(F.col("greenhouse") == greenhouse)

    def line(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("section"),
            F.to_json(F.struct("*")).alias("value"),
            F.lit(greenhouse).cast("string").alias("current_gh"),
        )

    return line(left_stats, "left").unionByName(line(right_stats, "right")).unionByName(line(pairs, "aligned"))
