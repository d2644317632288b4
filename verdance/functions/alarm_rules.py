"""Cause scoring of a hot window (R1-R6, T5) as one array expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdance import model as m
from verdance.functions.values import text


def _tiered(hits: list[tuple[Column, int]]) -> Column:
    """Score of the first tier whose condition holds, else null."""
    return F.coalesce(*[F.when(cond, F.lit(score)) for cond, score in hits])


def _reason(order: int, score: Column, reason: Column, detail: Column) -> Column:
    return F.when(
        score.isNotNull(),
        F.struct(
            (-score).alias("rank_key"),
            F.lit(order).alias("ord"),
            score.alias("score"),
            F.lit(f"R{order}").alias("rule"),
            reason.alias("reason"),
            detail.alias("detail"),
        ),
    )


def scored_reasons(
    temp: Column, hum: Column, soil: Column, light: Column, prev_temp: Column, recent_hot: Column
) -> Column:
    """Causes that apply, highest score first, ties in rule order; never empty."""
    sun = _tiered([(light >= limit, score) for limit, score in m.LIGHT_TIERS])
    strong = light >= m.LIGHT_TIERS[1][0]
    dry = _tiered([(hum < limit, score) for limit, score in m.HUMIDITY_TIERS])
    rise = temp - prev_temp
    rising = _tiered([(rise >= limit, score) for limit, score in m.RISE_TIERS])
    fast = rise >= m.RISE_TIERS[0][0]
    parched = _tiered([(soil < limit, score) for limit, score in m.SOIL_TIERS])
    lasting = F.when(recent_hot >= m.PERSIST_COUNT, F.lit(m.PERSIST_SCORE))

    mixed = F.when(F.coalesce(sun, dry, rising, parched, lasting).isNull(), F.lit(m.FALLBACK_SCORE))

    applying = F.array_compact(
        F.array(
            _reason(
                1,
                sun,
                F.when(strong, m.STRONG_LIGHT).otherwise(m.MILD_LIGHT),
                F.when(strong, text(m.STRONG_LIGHT_DETAIL, light)).otherwise(text(m.MILD_LIGHT_DETAIL, light)),
            ),
            _reason(2, dry, F.lit(m.DRY_AIR), text(m.DRY_AIR_DETAIL, hum)),
            _reason(
                3,
                rising,
                F.when(fast, text(m.FAST_RISE, rise)).otherwise(text(m.QUICK_RISE, rise)),
                F.when(fast, text(m.FAST_RISE_DETAIL, rise)).otherwise(text(m.QUICK_RISE_DETAIL, rise)),
            ),
            _reason(4, parched, F.lit(m.DRY_SOIL), text(m.DRY_SOIL_DETAIL, soil)),
            _reason(5, lasting, F.lit(m.PERSISTENT), text(m.PERSISTENT_DETAIL, recent_hot)),
            _reason(6, mixed, F.lit(m.MIXED), F.lit(m.MIXED_DETAIL)),
        )
    )
    fields = ("score", "rule", "reason", "detail")
    return F.transform(F.array_sort(applying), lambda r: F.struct(*[r[f].alias(f) for f in fields]))
