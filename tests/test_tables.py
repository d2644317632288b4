"""Window-table operators on hand-made rows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from verdance.model import WINDOW_STATS, AlarmSpec
from verdance.operators import tables
from verdance.operators.align import align, audit_join
from verdance.operators.priority import keyed_source, priority_source
from verdance.plans import alarms, compare, reports

T0 = dt.datetime(2024, 1, 1)
A, B, C = "大棚一", "大棚二", "大棚三"


def at(i):
    return T0 + dt.timedelta(seconds=5 * i)


def windows(spark, *rows):
    """rows of (key, index, temp[, hum, soil, light])"""
    full = []
    for key, i, temp, *rest in rows:
        hum, soil, light = rest if rest else (50.0, 40.0, 3000.0)
        full.append((key, at(i), at(i + 1), temp, hum, soil, light))
    return spark.createDataFrame(full, WINDOW_STATS)


def named(df):
    return df.withColumn("greenhouse", F.col("greenhouse_id"))


def pairs(df):
    return {(r["greenhouse"], r["win_start"]) for r in df.collect()}


def test_align_strict_j1(spark):
    left = windows(spark, (A, 1, 30.0), (B, 1, 31.0), (A, 2, 32.0))
    right = windows(spark, (A, 1, 29.5), (B, 2, 30.0))
    got = align(named(left), named(right)).collect()
    assert [(r["greenhouse"], r["win_start"], r["diff_temp"]) for r in got] == [(A, at(1), 0.5)]
    assert len(got[0]) == 15


def test_align_null_left_takes_largest_label_j2(spark):
    left = windows(spark, (None, 1, 30.0))
    right = windows(spark, (A, 1, 29.0), (B, 1, 28.0), (C, 1, 27.0), (A, 2, 20.0))
    got = align(named(left), named(right)).collect()
    assert [(r["greenhouse"], r["left_temp"], r["right_temp"]) for r in got] == [(B, 30.0, 28.0)]


def test_align_null_right_j3(spark):
    left = windows(spark, (A, 1, 29.0), (B, 1, 28.0))
    right = windows(spark, (None, 1, 30.0))
    got = align(named(left), named(right)).collect()
    assert [(r["greenhouse"], r["left_temp"], r["right_temp"]) for r in got] == [(B, 28.0, 30.0)]


def test_align_null_keys_match_each_other(spark):
    left, right = windows(spark, (None, 1, 30.0), (A, 1, 25.0)), windows(spark, (None, 1, 31.0), (B, 1, 26.0))
    got = align(named(left), named(right)).collect()
    assert [(r["greenhouse"], r["diff_temp"]) for r in got] == [(None, 1.0)]


def test_align_keeps_pairs_with_missing_values(spark):
    got = align(named(windows(spark, (A, 1, 30.0))), named(windows(spark, (A, 1, None)))).collect()
    assert len(got) == 1 and got[0]["diff_temp"] is None and got[0]["diff_hum"] == 0.0


def test_align_cut_prefers_strict_and_newest_t4(spark):
    left = windows(spark, (A, 1, 30.0), (A, 2, 30.0), (A, 3, 30.0), (None, 9, 30.0))
    right = windows(spark, (A, 1, 30.0), (A, 2, 30.0), (A, 3, 30.0), (B, 9, 30.0))
    assert pairs(align(named(left), named(right), 2)) == {(A, at(2)), (A, at(3))}
    assert pairs(align(named(left), named(right), 4)) == {(A, at(1)), (A, at(2)), (A, at(3)), (B, at(9))}
    assert pairs(align(named(left), named(right), 4, greenhouse=B)) == {(B, at(9))}


def brute_align(left, right):
    """Pairs of windows held as {(label, start)}; labels may be None."""
    out = {(k, k) for k in left & right}
    used_l, used_r = left & right, left & right
    for mine, other, flip in ((left, right, False), (right, left, True)):
        for k in sorted(mine - (used_r if flip else used_l), key=lambda k: k[1]):
            if k[0] is not None:
                continue
            free = sorted(o[0] for o in other - (used_l if flip else used_r) if o[1] == k[1] and o[0] is not None)
            if free:
                partner = (free[-1], k[1])
                (used_l if flip else used_r).add(partner)
                out.add((partner, k) if flip else (k, partner))
    return out


def test_align_against_brute_force(spark):
    rng = random.Random(3)
    names = [None, A, B, C]

    def some():
        return {(rng.choice(names), i) for i in range(60) for _ in range(rng.randint(0, 3))}

    left, right = some(), some()
    rows = [[(k, i, float(rng.randint(20, 35))) for k, i in side for _ in range(rng.randint(1, 3))] for side in (left, right)]
    got = align(*[named(windows(spark, *r)) for r in rows])
    want = brute_align(set(left), set(right))
    shown = sorted((str(l[0] if l[0] is not None else r[0]), at(l[1])) for l, r in want)
    assert sorted((str(r["greenhouse"]), r["win_start"]) for r in got.collect()) == shown


def test_compare_report_order_and_stats_a5(spark):
    t = named(windows(spark, (A, 1, 30.0), (A, 1, 31.0), (A, 2, 30.0)))
    got = compare.compare_report(t, t).collect()
    assert [r["win_start"] for r in got] == [at(1), at(2)] and got[0]["left_temp"] == 30.5
    fresh = compare.engine_stats(t, F.lit(at(3)) + F.make_interval(secs=F.lit(119))).first()
    stale = compare.engine_stats(t, F.lit(at(3)) + F.make_interval(secs=F.lit(120))).first()
    assert (fresh["windows"], fresh["last"], fresh["alive"], stale["alive"]) == (2, at(3), True, False)
    none = compare.engine_stats(t.limit(0), F.lit(at(3))).first()
    assert (none["windows"], none["last"], none["alive"]) == (0, None, False)


def test_audit_join_j5(spark):
    left = windows(spark, (None, 1, 30.0), (None, 1, 30.0), (None, 1, 31.0), ("gh_01", 1, 9.0), (None, 2, 30.0))
    right = windows(spark, ("gh_01", 1, 29.0), ("gh_01", 1, 29.0), ("gh_02", 2, 29.0))
    got = audit_join(left, right).collect()
    assert sorted((r["left_temp"], r["diff_temp"], r["n_pairs"]) for r in got) == [(30.0, 1.0, 4), (31.0, 2.0, 2)]


def test_dedup_is_idempotent_a4(spark):
    t = windows(spark, (A, 1, 30.0), (A, 1, 31.0), (None, 1, 20.0))
    once = tables.dedup_windows(t)
    assert sorted(map(str, once.collect())) == sorted(map(str, tables.dedup_windows(once).collect()))
    assert {(r["greenhouse_id"], r["avg_temp"]) for r in once.collect()} == {(A, 30.5), (None, 20.0)}


def test_duplicates_a15(spark):
    t = windows(spark, ("gh_01", 1, 30.0), ("gh_01", 1, 32.0), ("gh_02", 1, 30.0), ("gh_01", 900, 1.0), ("gh_01", 900, 2.0))
    every = tables.duplicate_windows(t).collect()
    assert [(r["win_start"], r["cnt"], r["min_temp"], r["max_temp"]) for r in every] == [
        (at(900), 2, 1.0, 2.0),
        (at(1), 2, 30.0, 32.0),
    ]
    recent = tables.duplicate_windows(t, F.lit(at(900)), minutes=30)
    assert [r["win_start"] for r in recent.collect()] == [at(900)]
    assert len(tables.duplicate_windows(t, newest=1).collect()) == 1


def test_key_probe_modes_a13(spark):
    one = windows(spark, ("gh_01", 1, 1.0), ("", 1, 1.0), (None, 1, 1.0))
    two = windows(spark, ("gh_01", 1, 1.0), ("gh_02", 1, 1.0))
    legacy = two.drop("greenhouse_id")
    assert [tuple(tables.probe_key(t).first()) for t in (one, two, legacy)] == [(True, False), (True, True), (False, False)]


def test_key_counts_a16_l12(spark):
    t = windows(spark, ("gh_01", 1, 1.0), ("gh_01", 2, 1.0), (None, 1, 1.0))
    assert [tuple(r) for r in tables.key_counts(t).collect()] == [("gh_01", 2), (None, 1)]
    assert [tuple(r) for r in tables.key_rows(t, ("gh_01", "x", None)).collect()] == [("gh_01", 2), ("x", 0), (None, 1)]


def test_legacy_table_reports(spark):
    legacy = windows(spark, ("x", 0, 31.0), ("x", 1, 32.0), ("x", 2, 33.0), ("x", 3, 34.0)).drop("greenhouse_id")
    got = reports.window_export(legacy, tables.multi_key(legacy)).collect()
    assert [r["大棚"] for r in got] == [A, C, B, A]
    assert [r["窗口开始"] for r in got][:1] == ["2024-01-01 00:00:15"]
    top = reports.alarm_top_synthetic(legacy).collect()
    assert [(r["greenhouse"], r["n"]) for r in top] == [(A, 2), (C, 1), (B, 1)]
    rank = reports.gh_rank_synthetic(legacy, last_n=2).collect()
    assert [(r["greenhouse"], r["mean_temp"]) for r in rank] == [(A, 34.0), (B, None), (C, 33.0)]
    assert alarms.alarms(alarms.history(legacy)).count() == 4


def test_real_mode_drops_rows_without_key(spark):
    t = windows(spark, ("gh_01", 1, 31.0), ("gh_02", 1, 32.0), ("", 1, 33.0), (None, 2, 34.0))
    assert {r["greenhouse"] for r in compare.load_windows(t, tables.multi_key(t)).collect()} == {A, B}
    assert {r["greenhouse"]: r["n"] for r in reports.alarm_top(t).collect()} == {A: 1, B: 1}
    assert [r["greenhouse"] for r in reports.gh_rank(t).collect()] == [B, A]


def test_reports_a6_a11_v3(spark):
    t = windows(spark, ("gh_01", 1, 31.0), ("gh_01", 2, 33.0), ("gh_02", 1, 20.0), ("gh_02", 3, 36.0))
    assert tuple(reports.alarm_count(t).first()) == (3, 33.3333, 36.0)
    assert tuple(reports.alarm_count(t, A).first()) == (2, 32.0, 33.0)
    assert tuple(reports.alarm_count(t, C).first()) == (0, None, None)
    labelled = compare.load_windows(t)
    assert {r["greenhouse"]: r["win_start"] for r in reports.gh_latest(labelled).collect()} == {A: at(2), B: at(3)}
    got = reports.gh_compare(labelled, A, B).first()
    assert (got["temp_1"], got["temp_2"], got["diff_temp"], got["verdict"]) == (32.0, 28.0, 4.0, "高")
    assert reports.gh_compare(labelled, A, C).first()["verdict"] is None
    means = {r["greenhouse"]: r["mean_temp"] for r in reports.gh_means(labelled, (A, C)).collect()}
    assert means == {A: 32.0}


def test_priority_source_j6(spark):
    first = windows(spark, ("gh_01", 1, 31.0), ("gh_02", 1, 20.0))
    second = windows(spark, ("gh_01", 2, 32.0), ("gh_02", 2, 33.0))
    hot = F.col("avg_temp") > 30

    def got(df):
        return sorted((r["greenhouse_id"], r["source"], r["avg_temp"]) for r in df.collect())

    assert got(priority_source(first, second, hot)) == [("gh_01", 1, 31.0)]
    assert got(priority_source(first.where("avg_temp < 30"), second, hot)) == [("gh_01", 2, 32.0), ("gh_02", 2, 33.0)]
    assert got(priority_source(first, second, hot, "greenhouse_id")) == [("gh_01", 1, 31.0), ("gh_02", 2, 33.0)]


def test_keyed_source_j6(spark):
    single, several = windows(spark, ("gh_01", 1, 31.0)), windows(spark, ("gh_01", 1, 30.0), ("gh_02", 1, 20.0))

    def got(primary, backup):
        table, real = keyed_source(primary, backup)
        keys = table.withColumn("real", real).select("greenhouse_id", "real").collect()
        return sorted(map(tuple, keys), key=repr)

    keys = sorted(((r["greenhouse_id"], True) for r in several.collect()), key=repr)
    assert got(single, several) == got(several, single) == keys
    assert got(single, single.drop("greenhouse_id")) == [(r["greenhouse_id"], False) for r in single.collect()]


def test_latest_windows_with_repeats_t2(spark):
    rng = random.Random(9)
    rows = [(k, i, float(rng.randint(20, 30))) for i in range(50) for k in (A, B, C) for _ in range(rng.randint(0, 3))]
    t = named(windows(spark, *rows))
    whole = tables.dedup_windows(t, "greenhouse").orderBy(F.desc("win_start"), "greenhouse")
    for n in (1, 7, 40, 1000):
        got = tables.latest_windows(t, n).orderBy(F.desc("win_start"), "greenhouse")
        assert got.collect() == whole.limit(n).collect()


# ---------------------------------------------------------------- looking back


def mean(xs):
    return sum(xs) / len(xs)


def brute_history(primary, backup, lookback):
    """{(key, start): (previous start, previous temp, recent hot)} over both tables."""
    sides = []
    for rows in (primary, backup):
        side = {}
        for key, i, temp in rows:
            side.setdefault((key, i), []).append(temp)
        sides.append({k: mean(v) for k, v in side.items()})
    out = {}
    for key, i in set(sides[0]) | set(sides[1]):
        prev, hot = None, 0
        for side in sides:
            earlier = [j for k, j in side if k == key and j < i]
            if prev is None and earlier:
                prev = (max(earlier), side[(key, max(earlier))])
            if hot == 0:
                hot = sum(1 for (k, j), t in side.items() if k == key and i - lookback <= j <= i and t > 30)
        out[(key, i)] = (prev, hot)
    return out


@pytest.mark.parametrize("bucket_windows", [12, 13, 40, 1000])
def test_history_against_brute_force(spark, bucket_windows):
    rng = random.Random(bucket_windows)

    def some(density):
        return [
            (key, i, float(rng.randint(27, 33)))
            for key in ("gh_01", "gh_02")
            for i in range(300)
            if rng.random() < density and not 120 < i < 200
            for _ in range(rng.choice((1, 1, 2)))
        ]

    first, second = some(0.3), some(0.6)
    spec = AlarmSpec(bucket_seconds=5 * bucket_windows)
    want = brute_history(first, second, 12)
    rows = alarms.history(windows(spark, *first), windows(spark, *second), spec).collect()
    keys = {A: "gh_01", B: "gh_02"}
    got = {}
    for r in rows:
        i = int((r["win_start"] - T0).total_seconds()) // 5
        prev = r["prev"] and (int((r["prev"]["win_start"] - T0).total_seconds()) // 5, r["prev"]["avg_temp"])
        got[(keys[r["greenhouse"]], i)] = (prev, r["recent_hot"])
    assert len(rows) == len(got) and got == want


def test_alarm_modes_r7(spark):
    first = windows(spark, ("gh_01", 1, 31.0), ("gh_01", 5, 20.0), ("gh_02", 2, 32.0))
    second = windows(spark, ("gh_01", 3, 33.0), ("gh_01", 5, 40.0), ("gh_03", 9, 35.0))
    every = alarms.alarms(alarms.history(first, second)).collect()
    # the primary's cool window at 5 wins over the backup's hot one
    assert {(r["greenhouse"], r["win_start"]) for r in every} == {(A, at(1)), (A, at(3)), (B, at(2)), (C, at(9))}
    assert [r["win_start"] for r in alarms.latest_alarm(first, second).collect()] == [at(2)]
    assert [r["win_start"] for r in alarms.latest_alarm(first.where("avg_temp < 30"), second).collect()] == [at(9)]
    assert [r["win_start"] for r in alarms.latest_alarm(first, second, greenhouse=C).collect()] == [at(9)]
    assert alarms.latest_alarm(first.where("avg_temp < 30")).collect() == []
    given = alarms.alarms_at(first, second, "2024-01-01 00:00:15").collect()
    assert [(r["greenhouse"], r["avg_temp"], r["prev"]["win_start"]) for r in given] == [(A, 33.0, at(1))]
    assert alarms.alarms_at(first, second, "2024-01-01 00:00:25").collect() == []
    assert alarms.alarms_at(first, second, "2024-01-01 00:00:15", greenhouse=B).collect() == []


def test_latest_alarm_judges_the_mean_of_repeats(spark):
    t = windows(spark, ("gh_01", 1, 31.0), ("gh_01", 2, 31.0), ("gh_01", 2, 20.0))
    assert [r["win_start"] for r in alarms.latest_alarm(t).collect()] == [at(1)]


def test_given_window_equals_history(spark):
    rng = random.Random(5)
    first = [(k, i, float(rng.randint(27, 33))) for k in ("gh_01", "gh_02") for i in range(80) if rng.random() < 0.4]
    second = [(k, i, float(rng.randint(27, 33))) for k in ("gh_01", "gh_02") for i in range(80) if rng.random() < 0.7]
    l, r = windows(spark, *first), windows(spark, *second)
    whole = alarms.alarms(alarms.history(l, r, AlarmSpec(bucket_seconds=100)))
    for i in (0, 17, 40, 79):
        want = whole.where(F.col("win_start") == at(i)).collect()
        assert sorted(map(str, alarms.alarms_at(l, r, F.lit(at(i))).collect())) == sorted(map(str, want))
        one = alarms.alarms_at(l, r, F.lit(at(i)), greenhouse=A).collect()
        assert list(map(str, one)) == [str(w) for w in want if w["greenhouse"] == A]


def rows_taken(monkeypatch, run):
    """How many rows of the window tables the searches look at."""
    taken, real = [], alarms._of
    monkeypatch.setattr(alarms, "_of", lambda t, *rest: (taken.append(t.count()), real(t, *rest))[1])
    out = run()
    monkeypatch.setattr(alarms, "_of", real)
    return sum(taken), out


def test_alarm_searches_do_not_read_all_history(spark, monkeypatch):
    """Ten times the history: the same rows are read, and the same alarm is found."""
    spec = AlarmSpec(lookback_seconds=60, bucket_seconds=200)
    seen = []
    for n in (200, 2000):
        rows = [(k, i, 31.0 if i == n - 7 else 25.0) for k in ("gh_01", "gh_02") for i in range(n)]
        first, second = windows(spark, *rows), windows(spark, *rows[::2])
        given, at_start = rows_taken(monkeypatch, lambda f=first, s=second, n=n: alarms.alarms_at(f, s, F.lit(at(n - 7)), spec).collect())
        newest, found = rows_taken(monkeypatch, lambda f=first, s=second: alarms.latest_alarm(f, s, spec).collect())
        assert [(r["greenhouse"], r["win_start"]) for r in found] == [(A, at(n - 7))]
        assert sorted((r["greenhouse"], r["prev"]["win_start"]) for r in at_start) == sorted((g, at(n - 8)) for g in (A, B))
        seen.append((given, newest))
    assert seen[0] == seen[1]


def test_alarm_search_goes_back_as_far_as_it_must(spark):
    """The previous window lies many slices back, for one greenhouse there is none, and a backup
    that is searched though the primary has windows but no hot one."""
    spec = AlarmSpec(lookback_seconds=60, bucket_seconds=100)
    first = windows(spark, ("gh_01", 0, 20.0), ("gh_01", 3000, 31.0), ("gh_02", 3000, 33.0), ("gh_03", 2999, 25.0))
    got = {r["greenhouse"]: r["prev"] and r["prev"]["win_start"] for r in alarms.alarms_at(first, None, F.lit(at(3000)), spec).collect()}
    assert got == {A: at(0), B: None}
    want = alarms.alarms(alarms.history(first, None, spec), spec).where(F.col("win_start") == at(3000)).collect()
    assert {r["greenhouse"]: r["recent_hot"] for r in want} == {A: 1, B: 1}
    cool, old = first.where("avg_temp < 30"), windows(spark, ("gh_01", 1, 35.0), ("gh_01", 2900, 20.0))
    assert [(r["win_start"], r["prev"]["win_start"]) for r in alarms.latest_alarm(cool, old, spec).collect()] == [(at(1), at(0))]


def test_label_filter_reaches_the_scan(spark, tmp_path):
    """L2: odd spellings and rows without key are kept; keys of others are told by the files."""
    keys = ("gh_01", "GH_01 ", "1", "大棚一", None, "", " ", "gh_02", "gh_03", "gh_99", " gh_99")
    rows = windows(spark, *[(k, i, 31.0) for i, k in enumerate(keys)])
    rows.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    for name in (A, B, C, "gh_99", "nobody"):
        kept = alarms._of(stored, name, 5)
        named = alarms._named(stored, 5).where(F.col("greenhouse") == name)
        assert sorted(map(str, kept.collect())) == sorted(map(str, named.collect()))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
        assert ("Not(In(greenhouse_id" if name in (A, B, C) else f"StringContains(greenhouse_id,{name})") in pushed


def test_alarm_spec_needs_room():
    with pytest.raises(ValueError):
        AlarmSpec(lookback_seconds=60, bucket_seconds=30)
