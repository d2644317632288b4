"""Looking back over a greenhouse's windows.

A greenhouse may hold a large share of all windows, so its history is never one
sort group. It is cut into time buckets; what a bucket needs from before its
start is brought in separately:

* windows of the last ``lookback_seconds`` of a bucket are copied into the next
  one, so a trailing range never leaves its bucket;
* the last window of each bucket (one row per greenhouse and bucket) is carried
  forward to the next non-empty bucket, so the previous window is found however
  large the gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.model import STATS, AlarmSpec
from verdance.operators.align import SIDES

MICROS = 1_000_000
_FIELDS = ("win_end", *STATS)


def _seen(side: str) -> Column:
    """The side's window with its start, null where the side has none."""
    fields = [F.col("win_start"), *[F.col(f"{side}.{f}").alias(f) for f in _FIELDS]]
    return F.when(F.col(side).isNotNull(), F.struct(*fields))


def look_back(rows: DataFrame, spec: AlarmSpec, sides: Sequence[str] = SIDES) -> DataFrame:
    """Adds, to each (greenhouse, win_start) row of ``align.paired``, the previous
    window ``prev`` and the number ``recent_hot`` of hot windows in the look-back
    that ends at the row (both ends inclusive).

    Each is taken from the first side that has any: the right side only serves
    where the left has no earlier window, or no hot window in the look-back (R7).
    """
    span, back = spec.bucket_seconds * MICROS, spec.lookback_seconds * MICROS
    at = F.unix_micros("win_start")
    own = F.floor(F.unix_seconds("win_start") / F.lit(spec.bucket_seconds))
    base = rows.select(
        "*", at.alias("_at"), own.alias("_own"), *[_seen(s).alias(f"_{s}") for s in sides]
    )

    # Last window of each bucket, carried to the buckets after it. Field by field, which
    # keeps the aggregation buffer fixed-width (hash, not sort, aggregation); a start
    # occurs once per greenhouse, so the fields of one window stay together.
    def last_field(s: str, f: str) -> Column:
        value = F.col("win_start") if f == "win_start" else F.col(f"{s}.{f}")
        return F.max_by(value, F.when(F.col(s).isNotNull(), F.col("_at"))).alias(f"_{s}_{f}")

    lasts = base.groupBy("greenhouse", F.col("_own").alias("_bucket")).agg(
        *[last_field(s, f) for s in sides for f in ("win_start", *_FIELDS)]
    )
    before = Window.partitionBy("greenhouse").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)

    def last_seen(s: str) -> Column:
        fields = F.struct(*[F.col(f"_{s}_{f}").alias(f) for f in ("win_start", *_FIELDS)])
        return F.when(F.col(f"_{s}_win_start").isNotNull(), fields)

    carried = lasts.select(
        F.col("greenhouse").alias("_gh"),
        F.col("_bucket").alias("_b"),
        *[F.last(last_seen(s), ignorenulls=True).over(before).alias(f"_carried_{s}") for s in sides],
    )

    into_next = F.col("_at") >= (F.col("_own") + 1) * F.lit(span) - F.lit(back)
    buckets = F.when(into_next, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
    placed = base.withColumn("_bucket", F.explode_outer(buckets)).join(
        carried, F.col("greenhouse").eqNullSafe(F.col("_gh")) & (F.col("_bucket") == F.col("_b")), "left"
    )

    group = Window.partitionBy("greenhouse", "_bucket").orderBy("_at")
    earlier = group.rowsBetween(Window.unboundedPreceding, -1)
    trailing = group.rangeBetween(-back, 0)
    out = placed
    for s in sides:
        hot = F.col(f"{s}.avg_temp") > spec.hot_above
        out = out.withColumn(
            f"_prev_{s}",
            F.coalesce(F.last(f"_{s}", ignorenulls=True).over(earlier), F.col(f"_carried_{s}")),
        ).withColumn(f"_hot_{s}", F.count(F.when(hot, 1)).over(trailing))
    prev = F.coalesce(*[F.col(f"_prev_{s}") for s in sides])
    counts = [F.nullif(F.col(f"_hot_{s}"), F.lit(0)) for s in sides]
    return out.where(F.col("_bucket") == F.col("_own")).select(
        *rows.columns, prev.alias("prev"), F.coalesce(*counts, F.lit(0)).alias("recent_hot")
    )


def at_window(rows: DataFrame, start: Column, spec: AlarmSpec, sides: Sequence[str] = SIDES) -> DataFrame:
    """``look_back`` for the windows that start at one time (L4): since every
    greenhouse needs one answer, its history is folded by aggregates, not sorted.
    Rows after ``start`` should be filtered from the tables beforehand."""
    # one column, so that a start given by a subquery stands in the plan once
    rows = rows.withColumn("_start", start)
    at, start = F.col("win_start"), F.col("_start")
    here = at == start
    recent = (at <= start) & (at >= start - F.make_interval(secs=F.lit(spec.lookback_seconds)))
    aggs = [F.max(start).alias("_max_start")]
    for s in sides:
        have = F.col(s).isNotNull()
        for f in _FIELDS:
            aggs.append(F.max(F.when(here, F.col(f"{s}.{f}"))).alias(f"_now_{s}_{f}"))
        for f in ("win_start", *_FIELDS):
            value = at if f == "win_start" else F.col(f"{s}.{f}")
            aggs.append(F.max_by(value, F.when(have & (at < start), at)).alias(f"_prev_{s}_{f}"))
        aggs.append(F.count_if(recent & (F.col(f"{s}.avg_temp") > spec.hot_above)).alias(f"_hot_{s}"))

    def packed(prefix: str, key: str, fields: tuple[str, ...]) -> Column:
        return F.when(F.col(f"{prefix}_{key}").isNotNull(), F.struct(*[F.col(f"{prefix}_{f}").alias(f) for f in fields]))

    now = [packed(f"_now_{s}", "win_end", _FIELDS) for s in sides]
    prev = [packed(f"_prev_{s}", "win_start", ("win_start", *_FIELDS)) for s in sides]
    counts = [F.nullif(F.col(f"_hot_{s}"), F.lit(0)) for s in sides]
    return (
        rows.groupBy("greenhouse")
        .agg(*aggs)
        .select(
            "greenhouse",
            F.col("_max_start").alias("win_start"),
            *[w.alias(s) for w, s in zip(now, sides)],
            F.coalesce(*prev).alias("prev"),
            F.coalesce(*counts, F.lit(0)).alias("recent_hot"),
        )
        .where(F.coalesce(*[F.col(s) for s in sides]).isNotNull())
    )
