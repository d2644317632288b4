"""Question routing as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdance import model as m


def mentions(q: Column, words: tuple[str, ...]) -> Column:
    """whether the text contains any of the words."""
    return reduce(lambda a, b: a | b, [F.contains(q, F.lit(w)) for w in words])


# characters that every greenhouse word has: texts without them are told apart at once
_SHARED = tuple(sorted(set.intersection(*(set(w) for ws in m.GREENHOUSE_WORDS.values() for w in ws))))


def first_greenhouse(q: Column, other_than: Column | None = None) -> Column:
    """Q2: first label, in label order, that the text names; Q3 with ``other_than``."""
    hits = []
    for name, words in m.GREENHOUSE_WORDS.items():
        hit = mentions(q, words)
        if other_than is not None:
            hit = (other_than != name) & hit
        hits.append(F.when(hit, F.lit(name)))
    worth_a_look = mentions(q, _SHARED) if other_than is None else other_than.isNotNull()
    return F.when(worth_a_look, F.coalesce(*hits))


def intent(q: Column, lowered: Column, named: Column, second: Column) -> Column:
    """Q1: first rule that matches. ``lowered`` is the text in lower case, ``named`` and
    ``second`` are as found by Q2 and Q3."""
    return (
        F.when(mentions(q, m.CAUSE_WORDS) & mentions(q, m.HEAT_WORDS), "alarm_reason")
        .when(mentions(lowered, m.ENGINE_WORDS) & mentions(lowered, m.DIFFERENCE_WORDS), "engine_diff")
        .when(mentions(q, m.ALARM_WORDS), F.when(mentions(q, m.TOP_WORDS), "alarm_top").otherwise("alarm_count"))
        .when(mentions(q, m.RANK_WORDS) & mentions(q, m.SUBJECT_WORDS), "gh_rank")
        .when(named.isNotNull() & mentions(q, m.LATEST_WORDS), "gh_latest")
        .when(second.isNotNull() & mentions(q, m.AND_WORDS), "gh_compare")
        .otherwise("unknown")
    )
