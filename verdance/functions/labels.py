"""Greenhouse keys and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdance.model import BLANKS, KEY_OF_LABEL, LABEL_OF_KEY, LABELS

def _lookup(key: Column, table: dict[str, str]) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def stripped(key: Column) -> Column:
    """Key without surrounding blanks; null when nothing is left."""
    return F.nullif(F.trim(key, F.lit(BLANKS)), F.lit(""))


def has_key(key: Column) -> Column:
    """L3: key neither null nor blank."""
    return F.trim(key) != ""


def normalized(key: Column) -> Column:
    """known keys to their label, blank to null, anything else unchanged."""
    s = stripped(key)
    return F.coalesce(_lookup(F.lower(s), LABEL_OF_KEY), s)


def _nth_label(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]), (n + 1).cast("int"))


def synthetic(win_start: Column, window_seconds: int = 5) -> Column:
    """label derived from the window's place in the day, one label per window in turn."""
    second = F.hour(win_start) * 3600 + F.minute(win_start) * 60 + F.second(win_start)
    return _nth_label(F.pmod(F.floor(second / window_seconds), F.lit(len(LABELS))))


def synthetic_text(text: Column, window_seconds: int = 5) -> Column:
    """The same for a timestamp held as text; text without a time of day
    falls back to the sum of its code points."""
    parts = F.split(F.rtrim(text), ":")

    def number(c: Column) -> Column:
        return F.when(F.translate(c, "0123456789", "") == "", c.try_cast("int"))

    def two(place: int) -> Column:
        part = F.try_element_at(parts, F.lit(place))
        return F.when(F.length(part) == 2, number(part))

    before = F.try_element_at(parts, F.lit(-3))
    hours = F.coalesce(number(F.right(before, F.lit(2))), number(F.right(before, F.lit(1))))
    second = hours * 3600 + two(-2) * 60 + two(-1)
    points = F.aggregate(
        F.transform(F.split(text, ""), F.ascii), F.lit(0).cast("long"), lambda acc, x: acc + x
    )
    slot = F.coalesce(F.floor(second / window_seconds), points)
    return _nth_label(F.pmod(slot, F.lit(len(LABELS))))


def label(key: Column, win_start: Column, window_seconds: int = 5) -> Column:
    """real label if there is one, else the synthetic."""
    return F.coalesce(normalized(key), synthetic(win_start, window_seconds))


def key_of(label_col: Column) -> Column:
    """label back to key; unknown labels unchanged."""
    return F.coalesce(_lookup(label_col, KEY_OF_LABEL), label_col)


def may_be(key: Column, name: str) -> Column:
    """L2: a condition that every row labelled ``name`` fulfils and that file statistics and
    dictionaries can judge: not the usual spelling of another greenhouse's key, or for a name
    that is no known label a key that contains it. The exact label is for a filter behind it."""
    if name in LABELS:
        others = [k for k, v in LABEL_OF_KEY.items() if v != name]
        return key.isNull() | ~key.isin(*others)
    return F.contains(key, F.lit(name))
