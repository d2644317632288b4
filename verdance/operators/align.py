"""Aligning two window sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.functions.values import abs_diff
from verdance.model import SHORT, STATS

SIDES = ("left", "right")


def paired(left: DataFrame, right: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """Both sets side by side, one row per (greenhouse, win_start) found in either.

    Columns ``left`` and ``right`` are structs of the window's end and its four
    statistics (mean of repeats, A4), null where that side has no such window;
    without a right set there is no ``right``.
    Removing repeats and matching happen in one aggregation: rows are tagged with
    their side and grouped once, which costs a single shuffle of pre-combined rows
    and matches null greenhouses with each other without a null-safe join.
    """
    sets = {"left": left} if right is None else {"left": left, "right": right}

    def tagged(side: str) -> DataFrame:
        return sets[side].select("greenhouse", "win_start", "win_end", *STATS, F.lit(side).alias("side"))

    def only(side: str, c: str) -> Column:
        return F.when(F.col("side") == side, F.col(c))

    aggs = []
    for side in sets:
        aggs.append(F.max(only(side, "win_end")).alias(f"{side}_win_end"))
        for s in STATS:
            mean = F.avg(only(side, s))
            aggs.append((mean if digits is None else F.round(mean, digits)).alias(f"{side}_{s}"))

    def packed(side: str) -> Column:
        fields = [F.col(f"{side}_{c}").alias(c) for c in ("win_end", *STATS)]
        return F.when(F.col(f"{side}_win_end").isNotNull(), F.struct(*fields)).alias(side)

    rows = reduce(DataFrame.unionByName, map(tagged, sets))
    return rows.groupBy("greenhouse", "win_start").agg(*aggs).select(
        "greenhouse", "win_start", *map(packed, sets)
    )


def _pairs(matched: DataFrame, step: Column) -> DataFrame:
    cols = [F.col("greenhouse"), F.col("win_start"), F.col("left.win_end").alias("win_end")]
    for s in STATS:
        a, b = F.col(f"left.{s}"), F.col(f"right.{s}")
        name = SHORT[s]
        cols += [a.alias(f"left_{name}"), b.alias(f"right_{name}"), abs_diff(a, b).alias(f"diff_{name}")]
    return matched.select(*cols, step.alias("step"))


def _unkeyed_pairs(rows: DataFrame) -> DataFrame:
    """An unmatched window without greenhouse on one side goes with the
    unmatched window of the same start and the largest label on the other.

    A side has at most one window without greenhouse per start (``paired`` merged its
    repeats), and where both sides have one they matched each other. So a start has at
    most one such row, and only the starts that have one are looked at: their windows of
    the other side meet it and the largest label stays. Each condition takes a column that the
    grouping makes, and starts meet null-safely, which says nothing of a single start: so no
    condition sinks below the grouping, and its one shuffle serves all uses of ``rows``.
    """
    left, right, name = F.col("left"), F.col("right"), F.col("greenhouse")
    lone = left.isNull() | right.isNull()
    unnamed = rows.where(F.when(lone, name.isNull())).select(
        F.col("win_start").alias("_start"), left.alias("null_left"), right.alias("null_right")
    )
    other = F.when(F.col("null_left").isNotNull(), right).otherwise(left)
    named = rows.where(F.when(lone, name.isNotNull()))
    met = named.join(unnamed, F.col("win_start").eqNullSafe(F.col("_start"))).where(other.isNotNull())
    largest = Window.partitionBy("win_start").orderBy(F.desc("greenhouse"))
    matched = met.withColumn("_place", F.row_number().over(largest)).where("_place = 1").select(
        "greenhouse",
        "win_start",
        F.coalesce("null_left", "left").alias("left"),
        F.coalesce("null_right", "right").alias("right"),
        F.when(F.col("null_left").isNotNull(), 2).otherwise(3).alias("step"),
    )
    return _pairs(matched, F.col("step"))


def align(
    left: DataFrame,
    right: DataFrame,
    max_n: int | None = None,
    greenhouse: str | None = None,
    fallback: bool = True,
    digits: int = 2,
) -> DataFrame:
    """Aligned pairs with absolute differences, 15 columns.

    J1 matches on (greenhouse, win_start); J2 and J3 then pair what is left without
    a greenhouse. ``max_n`` keeps the newest strict pairs and fills up with fallback
    pairs (T4); ``greenhouse`` filters after that cut (L9). Inputs have a
    ``greenhouse`` column and may repeat windows.
    """
    rows = paired(left, right, digits)
    out = _pairs(rows.where(F.col("left").isNotNull() & F.col("right").isNotNull()), F.lit(1))
    if fallback:
        out = out.unionByName(_unkeyed_pairs(rows))
    if max_n is not None:
        strict_start = F.when(F.col("step") == 1, F.col("win_start"))
        strict_name = F.when(F.col("step") == 1, F.col("greenhouse"))
        out = out.orderBy(
            "step", F.desc_nulls_last(strict_start), F.asc(strict_name), F.desc("greenhouse"), F.desc("win_start")
        ).limit(max_n)
    if greenhouse is not None:
        out = out.where(F.col("greenhouse") == greenhouse)
    return out.drop("step")


def audit_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str | None = None,
    right_key: str | None = "gh_01",
    newest: int | None = None,
) -> DataFrame:
    """Rows of both tables with the same start, each side held to one key value
    (null counts as a value, L10), at full precision.

    Identical rows are counted before the join, so copies of a window do not
    multiply in it; ``n_pairs`` says how many row pairs each result stands for.
    """

    def side(df: DataFrame, key: str | None, name: str) -> DataFrame:
        cond = F.col("greenhouse_id").isNull() if key is None else F.col("greenhouse_id") == key
        cols = [F.col("greenhouse_id").alias(f"{name}_key")]
        cols += [F.col(s).alias(f"{name}_{SHORT[s]}") for s in STATS]
        names = [f"{name}_key"] + [f"{name}_{SHORT[s]}" for s in STATS]
        return (
            df.where(cond).select("win_start", *cols)
            .groupBy("win_start", *names)
            .agg(F.count("*").alias(f"{name}_n"))
        )

    both = side(left, left_key, "left").join(side(right, right_key, "right"), "win_start")
    cols = ["win_start", "left_key", "right_key"]
    for name in SHORT.values():
        a, b = F.col(f"left_{name}"), F.col(f"right_{name}")
        cols += [a, b, abs_diff(a, b, None).alias(f"diff_{name}")]
    out = both.select(*cols, (F.col("left_n") * F.col("right_n")).alias("n_pairs"))
    out = out.orderBy(F.desc("win_start"), *[F.col(f"{s}_{n}") for s in SIDES for n in SHORT.values()])
    return out if newest is None else out.limit(newest)
