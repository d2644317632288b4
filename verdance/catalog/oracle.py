"""``oracle_sql()``: the same results in plain SQL (DuckDB), written independently of
the DataFrame code: joins, ranking and range frames where that uses aggregation.

Rounding goes through the shortest decimal text of a double, as Spark's does.
"""

from __future__ import annotations

from verdance import model as m


def rnd(x: str, digits: int) -> str:
    return f"round(({x})::varchar::decimal(38,18), {digits})::double"


def fmt(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {rnd(x, digits)})"


def quoted(*words: str) -> str:
    return ", ".join(f"'{w}'" for w in words)


def ctes(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())


READINGS = """
SELECT event_id, event_type, ts AS event_time,
       'gh_0' || (user_id % 3 + 1)::varchar AS greenhouse_id,
       2200 + (event_id * 37) % 1400 AS air_temp,
       2000 + (event_id * 53) % 5000 AS air_humidity,
       1000 + (event_id * 71) % 5000 AS soil_humidity,
       200000 + (event_id * 7919) % 9800000 AS light
FROM events"""

_WINDOW = """greenhouse_id, date_trunc('hour', event_time) AS win_start,
       date_trunc('hour', event_time) + INTERVAL 1 HOUR AS win_end"""


def _plain(source: str = "readings", where: str = "true", key: str = "greenhouse_id") -> str:
    means = ", ".join(f"sum({a})::double / count({a}) / 100 AS {m.STAT_OF[a]}" for a in m.METRICS[:3])
    window = _WINDOW.replace("greenhouse_id", f"{key} AS greenhouse_id", 1)
    return f"SELECT {window}, {means}, max(light)::double / 100 AS max_light FROM {source} WHERE {where} GROUP BY ALL"


def _trimmed() -> str:
    def mean(a: str) -> str:
        cut = f"(sum({a}) - min({a}) - max({a}))::double / nullif(count({a}) - 2, 0)"
        return rnd(f"CASE WHEN count({a}) > 2 THEN {cut} ELSE sum({a})::double / count({a}) END / 100", 4)

    means = ", ".join(f"{mean(a)} AS {m.STAT_OF[a]}" for a in m.METRICS[:3])
    return f"SELECT {_WINDOW}, {means}, {rnd('max(light)::double / 100', 4)} AS max_light FROM readings GROUP BY ALL"


STATS = ", ".join(m.STATS)
LABEL_CASE = "CASE {k} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.LABEL_OF_KEY.items() if k[0] == "g") + " END"
SYNTH = "[" + quoted(*m.LABELS) + "][(date_part('hour', {t})::int % 3) + 1]"


def label(key: str = "greenhouse_id") -> str:
    return LABEL_CASE.format(k=key)


def synth(at: str) -> str:
    return SYNTH.format(t=at)


BASE = {
    "readings": READINGS,
    "l": _plain(),
    "r": _trimmed(),
    "c": "SELECT * FROM l WHERE date_part('hour', win_start) % 4 <> 1",
    "one": _plain(key="'gh_01'"),
    "rep": """SELECT greenhouse_id, win_start, win_end, avg_temp + i AS avg_temp, avg_humidity,
                     avg_soil_humidity, max_light
              FROM l, unnest(range(1 + (date_part('hour', win_start)::int % 2))) AS t(i)""",
    "now": "SELECT max(event_time) AS t FROM readings",
}


def q(body: str, **more: str) -> str:
    return ctes(**(BASE | more)) + "\n" + body


# ---------------------------------------------------------------- ingest

PARSED_KEY = "CASE WHEN event_type IN ('error', 'signup') THEN {blank} ELSE greenhouse_id END"

INGEST = {
    "readings": q(f"""
SELECT event_id, {PARSED_KEY.format(blank="'gh_01'")} AS greenhouse_id, air_temp::double AS air_temp,
       air_humidity::double AS air_humidity, soil_humidity::double AS soil_humidity, light::double AS light,
       epoch_us(event_time) // 1000 AS timestamp, date_trunc('millisecond', event_time) AS event_time
FROM readings WHERE event_type <> 'purchase'"""),
    "rejected_readings": q("""
SELECT 'bad air_temp' AS reject, count(*) AS n FROM readings WHERE event_type = 'purchase'"""),
    # the permissive parse: a number held as text is not a number
    "lenient_readings": q("""
SELECT event_id, CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE greenhouse_id END AS greenhouse_id,
       CASE WHEN event_type <> 'purchase' THEN air_temp END::double AS air_temp, air_humidity::double AS air_humidity, soil_humidity::double AS soil_humidity,
       light::double AS light, epoch_us(event_time) // 1000 AS timestamp,
       date_trunc('millisecond', event_time) AS event_time
FROM readings"""),
    "topic_fanout": q("""
SELECT greenhouse_id AS key, topic,
       '{"event_id":' || event_id || ',"greenhouse_id":"' || greenhouse_id || '","air_temp":' || air_temp ||
       ',"air_humidity":' || air_humidity || ',"soil_humidity":' || soil_humidity || ',"light":' || light || '}' AS value
FROM readings, unnest(['readings_a', 'readings_b']) AS t(topic)"""),
}

# ---------------------------------------------------------------- windows

_FEED = "greenhouse_id, win_end AS ts, avg_temp AS air_temp_avg, avg_humidity AS air_humidity_avg, avg_soil_humidity AS soil_humidity_avg, max_light AS light_avg"

# readings in degrees and percent; each window is sorted and its ends are cut off
DOUBLES = """
SELECT greenhouse_id, date_trunc('millisecond', event_time) AS event_time, CASE WHEN event_id % 331 <> 7 THEN air_temp / 100.0
    ELSE [1e17, 1e300, 'inf'::double][(event_id // 331) % 3 + 1] END::double AS air_temp,
  air_humidity / 100.0 AS air_humidity, soil_humidity / 100.0 AS soil_humidity, light / 100.0 AS light FROM readings"""


def _small(x: str) -> str:
    """Rounded where the value has room for it."""
    return f"CASE WHEN abs({x}) < 1e15 THEN {rnd(f'CASE WHEN abs({x}) < 1e15 THEN {x} END', 4)} ELSE {x} END"


def _sliced(a: str) -> str:
    """Mean of the sorted values without the first and last; in decimals where they fit, as a
    sum of doubles falls beside the halves that are rounded."""
    values = f"list_sort(list({a}))"
    rest = f"CASE WHEN count({a}) > 2 THEN list_slice({values}, 2, count({a}) - 1) ELSE {values} END"
    exact = f"list_sum(list_transform({rest}, lambda x: TRY_CAST(x AS DECIMAL(28, 6))))::double"
    fits = f"coalesce(list_max(list_transform({rest}, lambda x: abs(x))) < 1e15, false)"
    return f"CASE WHEN {fits} THEN {exact} ELSE list_sum({rest}) END / len({rest})"


SORTED = ", ".join(f"{_sliced(a)} AS {m.STAT_OF[a]}" for a in m.METRICS[:3])

SLIDING = q(
    "SELECT greenhouse_id, s + INTERVAL 2 HOUR AS ts, "
    + ", ".join(f"sum({a})::double / count({a}) / 100 AS {f}" for a, f in zip(m.METRICS, m.FEED_METRICS))
    + """ FROM (SELECT *, unnest([date_trunc('hour', event_time), date_trunc('hour', event_time) - INTERVAL 1 HOUR]) AS s
               FROM readings) GROUP BY greenhouse_id, s"""
)

WINDOWS = {
    "tumbling_avg_max": q("SELECT * FROM l"),
    "tumbling_trimmed_mean": q("SELECT * FROM r"),
    "trimmed_mean_doubles": q(
        "SELECT greenhouse_id, win_start, win_end, " + ", ".join(f"{_small(s)} AS {s}" for s in m.STATS) + " FROM sorted",
        doubles=DOUBLES,
        sorted=f"SELECT {_WINDOW}, {SORTED}, max(light) AS max_light FROM doubles GROUP BY ALL",
    ),
    "tumbling_avg_doubles": q(
        f"""SELECT {_WINDOW}, {", ".join(f"{rnd(f'avg({a})', 4)} AS {m.STAT_OF[a]}" for a in m.METRICS[:3])},
       {rnd("max(light)", 4)} AS max_light FROM doubles WHERE abs(air_temp) < 1e15 GROUP BY ALL""",
        doubles=DOUBLES,
    ),
    "rejected_outliers": q(
        "SELECT 'air_temp out of range' AS reject, count(*) AS n FROM doubles WHERE NOT abs(air_temp) < 1e15 GROUP BY 1", doubles=DOUBLES
    ),
    "sliding_avg": SLIDING,
    "feed": q(f"SELECT {_FEED} FROM l"),
    "json_payload": q(
        """SELECT greenhouse_id AS key,
       '{"greenhouse_id":"' || greenhouse_id || '","ts":"' || strftime(win_end, '%Y-%m-%dT%H:%M:%S.000Z') || '"' || """
        + " || ".join(f"',\"{f}\":' || {s}::varchar" for f, s in zip(m.FEED_METRICS, m.STATS))
        + " || '}' AS value FROM r"
    ),
}

# ---------------------------------------------------------------- window tables

TABLES = {
    "dedup_windows": q(
        "SELECT greenhouse_id, win_start, win_end, "
        + ", ".join(f"sum({s}) / count({s}) AS {s}" for s in m.STATS)
        + " FROM rep GROUP BY ALL"
    ),
    "duplicate_windows": q("""
SELECT win_start, greenhouse_id, count(*) AS cnt, min(avg_temp) AS min_temp, max(avg_temp) AS max_temp,
       min(avg_humidity) AS min_humidity, max(avg_humidity) AS max_humidity
FROM rep WHERE win_start >= (SELECT t FROM now) - INTERVAL 360 HOUR
GROUP BY ALL HAVING count(*) > 1"""),
    "key_counts": q("SELECT nullif(greenhouse_id, 'gh_02') AS greenhouse_id, count(*) AS n FROM l GROUP BY 1"),
    "key_rows": q("""
SELECT p.k AS greenhouse_id, (SELECT count(*) FROM l WHERE nullif(greenhouse_id, 'gh_02') IS NOT DISTINCT FROM p.k) AS n
FROM (VALUES ('gh_01'), ('大棚一'), ('1'), (NULL)) AS p(k)"""),
    "key_probe": q("SELECT true AS has_key, count(DISTINCT nullif(greenhouse_id, '')) >= 2 AS multi_key FROM l"),
    "normalized_labels": q(f"""
SELECT event_id, {label()} AS greenhouse, {label()} AS from_spelling, {label()} AS from_digit,
       greenhouse_id || '9' AS unknown_key, NULL::varchar AS blank_key, greenhouse_id AS back
FROM readings"""),
    "synthetic_labels": q(f"""
SELECT event_id, names[slot % 3 + 1] AS by_time, names[slot % 3 + 1] AS by_text, names[points % 3 + 1] AS by_code_points,
       CASE WHEN event_type = 'click' THEN {label()} ELSE names[slot % 3 + 1] END AS label
FROM (SELECT *, [{quoted(*m.LABELS)}] AS names,
             (date_part('hour', event_time) * 3600 + date_part('minute', event_time) * 60
              + floor(date_part('second', event_time)))::bigint // 5 AS slot,
             list_sum(list_transform(string_split(strftime(event_time, '%Y-%m-%d'), ''), lambda x: unicode(x)))::bigint AS points
      FROM readings)"""),
}

# ---------------------------------------------------------------- comparison


def _side(table: str, name: str) -> str:
    means = ", ".join(f"{rnd(f'sum({s}) / count({s})', 2)} AS {s}" for s in m.STATS)
    return f"SELECT {name} AS g, win_start, max(win_end) AS win_end, {means} FROM {table} GROUP BY ALL"


def _pair(name: str, a: str = "a", b: str = "b") -> str:
    cols = [f"{name} AS greenhouse", f"{a}.win_start AS win_start", f"{a}.win_end AS win_end"]
    for s in m.STATS:
        n = m.SHORT[s]
        cols += [f"{a}.{s} AS left_{n}", f"{b}.{s} AS right_{n}"]
        cols.append(rnd(f"abs({a}.{s} - {b}.{s})", 2) + f" AS diff_{n}")
    return ", ".join(cols)


def aligned(left_label: str, right_label: str) -> dict[str, str]:
    """Three passes: strict match, then one-to-one per start for rows without label."""

    def rest(mine: str, other: str) -> str:
        return f"""SELECT x.*, row_number() OVER (PARTITION BY win_start, g IS NULL ORDER BY g DESC) AS rn FROM {mine} x
          WHERE NOT EXISTS (SELECT 1 FROM {other} y WHERE y.win_start = x.win_start AND y.g IS NOT DISTINCT FROM x.g)"""

    return {
        "a": _side("l", left_label),
        "b": _side("r", right_label),
        "ra": rest("a", "b"),
        "rb": rest("b", "a"),
        "pairs": f"""
SELECT {_pair("a.g")} FROM a JOIN b ON a.win_start = b.win_start AND a.g IS NOT DISTINCT FROM b.g
UNION ALL
SELECT {_pair("rb.g", "ra", "rb")} FROM ra JOIN rb USING (win_start, rn) WHERE ra.g IS NULL AND rb.g IS NOT NULL
UNION ALL
SELECT {_pair("ra.g", "ra", "rb")} FROM ra JOIN rb USING (win_start, rn) WHERE ra.g IS NOT NULL AND rb.g IS NULL""",
    }


SOME_KEYS = LABEL_CASE.format(k="nullif(nullif(greenhouse_id, 'gh_01'), 'gh_02')")
ALIVE = "epoch_us((SELECT t FROM now)) - epoch_us(max(win_end)) < 24::bigint * 3600 * 1000000"

_AUDIT = ", ".join(
    f"a.{s} AS left_{n}, b.{s} AS right_{n}, abs(a.{s} - b.{s}) AS diff_{n}" for s, n in m.SHORT.items()
)

EXPORT_PAIR = [
    "greenhouse",
    "strftime(win_start, '%Y-%m-%d %H:%M:%S')",
    "strftime(win_end, '%Y-%m-%d %H:%M:%S')",
] + [f"{p}_{n}" for n in m.SHORT.values() for p in ("left", "right", "diff")]

COMPARE = {
    "engine_stats": q(
        " UNION ALL ".join(
            f"SELECT '{name}' AS engine, count(DISTINCT win_start) AS windows, max(win_end) AS last, {ALIVE} AS alive FROM {t}"
            for name, t in (("left", "l"), ("right", "r"))
        )
    ),
    "engine_align": q("SELECT * FROM pairs", **aligned(label(), label())),
    "engine_align_null_left": q("SELECT * FROM pairs", **aligned(SOME_KEYS, label())),
    "engine_align_null_right": q("SELECT * FROM pairs", **aligned(label(), SOME_KEYS)),
    "engine_align_one": q("SELECT * FROM pairs WHERE greenhouse = '大棚二'", **aligned(label(), label())),
    "engine_diff": q(
        f"""SELECT lw AS left_windows, la AS left_alive, rw AS right_windows, ra AS right_alive,
       (SELECT count(*) FROM pairs) AS pairs, (SELECT {rnd("avg(diff_temp)", 4)} FROM pairs) AS avg_diff_temp
FROM (SELECT count(DISTINCT win_start) AS lw, {ALIVE} AS la FROM l),
     (SELECT count(DISTINCT win_start) AS rw, {ALIVE} AS ra FROM r)""",
        **aligned(label(), label()),
    ),
    "compare_export": q(
        "SELECT " + ", ".join(f'{c} AS "{h}"' for c, h in zip(EXPORT_PAIR, m.COMPARE_HEADER)) + " FROM pairs",
        **aligned(label(), label()),
    ),
    "audit_join": q(
        f"""SELECT win_start, NULL::varchar AS left_key, b.greenhouse_id AS right_key, {_AUDIT}, 1::bigint AS n_pairs
FROM (SELECT * FROM rep WHERE greenhouse_id = 'gh_01') a JOIN (SELECT * FROM r WHERE greenhouse_id = 'gh_01') b USING (win_start)"""
    ),
    "priority_source": q("""
SELECT *, 1 AS source FROM c WHERE avg_temp > 30
UNION ALL
SELECT *, 2 AS source FROM r WHERE avg_temp > 30 AND NOT EXISTS (SELECT 1 FROM c WHERE avg_temp > 30)"""),
    # twenty degrees colder, the third greenhouse (or every one) is never hot in the primary
    "priority_backup": q("SELECT *, 2 AS source FROM r WHERE avg_temp > 30"),
    "priority_by_greenhouse": q("""
SELECT *, 1 AS source FROM l WHERE avg_temp > 30 AND greenhouse_id <> 'gh_03'
UNION ALL
SELECT *, 2 AS source FROM r WHERE avg_temp > 30 AND greenhouse_id NOT IN
  (SELECT greenhouse_id FROM l WHERE avg_temp > 30 AND greenhouse_id <> 'gh_03')"""),
}

# ---------------------------------------------------------------- alarms


def _history(primary: str, backup: str | None) -> dict[str, str]:
    """Plain window functions over each greenhouse's whole history."""
    # one row per greenhouse and start; side p primary, b backup
    second = f"SELECT * FROM {backup}" if backup else f"SELECT * FROM {primary} WHERE false"
    cols = ", ".join(
        f"{t}.{c} AS {t}_{c}" for t in ("p", "b") for c in ("win_end", *m.STATS)
    )
    seen = ", ".join(
        f"""last_value(CASE WHEN {t}_win_end IS NOT NULL THEN {{'win_start': win_start, 'temp': {t}_avg_temp, 'hum': {t}_avg_humidity,
            'soil': {t}_avg_soil_humidity, 'light': {t}_max_light}} END IGNORE NULLS) OVER w_before AS {t}_prev,
        count(*) FILTER ({t}_avg_temp > 30) OVER w_trailing AS {t}_hot"""
        for t in ("p", "b")
    )
    return {
        "p": f"SELECT {label()} AS g, * FROM {primary}",
        "b": f"SELECT {label()} AS g, * FROM ({second})",
        "sided": f"SELECT coalesce(p.g, b.g) AS greenhouse, coalesce(p.win_start, b.win_start) AS win_start, {cols} FROM p FULL JOIN b ON p.g = b.g AND p.win_start = b.win_start",
        "seen": f"""SELECT *, {seen} FROM sided
          WINDOW w_before AS (PARTITION BY greenhouse ORDER BY win_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                 w_trailing AS (PARTITION BY greenhouse ORDER BY win_start RANGE BETWEEN INTERVAL 12 HOUR PRECEDING AND CURRENT ROW)""",
        "h": """SELECT *, coalesce(p_prev, b_prev) AS prev, CASE WHEN p_hot > 0 THEN p_hot ELSE b_hot END AS recent_hot,
          p_win_end IS NOT NULL AS is_p FROM seen""",
    }


def _chosen(rows: str = "h", side: str = "is_p") -> str:
    cols = ", ".join(
        f"CASE WHEN {side} THEN p_{c} ELSE b_{c} END AS {c}" for c in ("win_end", *m.STATS)
    )
    return f"SELECT * FROM (SELECT greenhouse, win_start, {cols}, prev, recent_hot FROM {rows}) WHERE avg_temp > 30"


def _tiers(x: str, op: str, tiers) -> str:
    return "CASE " + " ".join(f"WHEN {x} {op} {limit} THEN {score}" for limit, score in tiers) + " END"


def _told(template: str, value: str) -> str:
    """A fixed text with one number in it, as concatenated SQL."""
    for spec, digits in (("%.0f", 0), ("%.1f", 1)):
        if spec in template:
            before, after = template.split(spec)
            return f"'{before}' || {fmt(value, digits)} || '{after}'".replace("%%", "%")
    before, after = template.split("%d")
    return f"'{before}' || {value} || '{after}'"


def _reasons() -> dict[str, str]:
    rise = "(avg_temp - prev.temp)"
    strong = f"max_light >= {m.LIGHT_TIERS[1][0]}"
    fast = f"{rise} >= {m.RISE_TIERS[0][0]}"

    def either(cond: str, yes: str, no: str) -> str:
        return f"CASE WHEN {cond} THEN {yes} ELSE {no} END"

    rules = [
        (
            "R1",
            _tiers("max_light", ">=", m.LIGHT_TIERS),
            either(strong, f"'{m.STRONG_LIGHT}'", f"'{m.MILD_LIGHT}'"),
            either(strong, _told(m.STRONG_LIGHT_DETAIL, "max_light"), _told(m.MILD_LIGHT_DETAIL, "max_light")),
        ),
        ("R2", _tiers("avg_humidity", "<", m.HUMIDITY_TIERS), f"'{m.DRY_AIR}'", _told(m.DRY_AIR_DETAIL, "avg_humidity")),
        (
            "R3",
            _tiers(rise, ">=", m.RISE_TIERS),
            either(fast, _told(m.FAST_RISE, rise), _told(m.QUICK_RISE, rise)),
            either(fast, _told(m.FAST_RISE_DETAIL, rise), _told(m.QUICK_RISE_DETAIL, rise)),
        ),
        ("R4", _tiers("avg_soil_humidity", "<", m.SOIL_TIERS), f"'{m.DRY_SOIL}'", _told(m.DRY_SOIL_DETAIL, "avg_soil_humidity")),
        (
            "R5",
            f"CASE WHEN recent_hot >= {m.PERSIST_COUNT} THEN {m.PERSIST_SCORE} END",
            f"'{m.PERSISTENT}'",
            _told(m.PERSISTENT_DETAIL, "recent_hot"),
        ),
    ]
    hits = "\nUNION ALL\n".join(
        f"SELECT alarm.*, {score} AS score, '{rule}' AS rule, {reason} AS reason, {detail} AS detail FROM alarm WHERE ({score}) IS NOT NULL"
        for rule, score, reason, detail in rules
    )
    return {
        "hits": hits,
        "scored": f"""SELECT * FROM hits UNION ALL
          SELECT alarm.*, {m.FALLBACK_SCORE}, 'R6', '{m.MIXED}', '{m.MIXED_DETAIL}' FROM alarm
          WHERE NOT EXISTS (SELECT 1 FROM hits WHERE hits.greenhouse = alarm.greenhouse AND hits.win_start = alarm.win_start)""",
        "ranked": """SELECT *, (row_number() OVER (PARTITION BY greenhouse, win_start ORDER BY score DESC, rule))::int AS rank,
          (count(*) OVER (PARTITION BY greenhouse, win_start) - 1)::int AS others FROM scored""",
    }


def alarm_sql(body: str, primary: str, backup: str | None, alarm: str | None = None) -> str:
    return q(body, **_history(primary, backup), alarm=alarm or _chosen(), **_reasons())


REASON_ROWS = "SELECT greenhouse, win_start, avg_temp, recent_hot, rank, score::int AS score, rule, reason, detail FROM ranked"
BRIEF = """SELECT greenhouse, win_start, win_end, avg_temp, prev.win_start AS prev_start, recent_hot, rule, reason,
       others, score::int AS confidence FROM ranked WHERE rank = 1"""


def _latest(where: str = "true") -> str:
    """Newest hot window of the primary if it has one, else of the backup."""
    return f"""SELECT * EXCLUDE (source) FROM (
      SELECT *, 1 AS source FROM ({_chosen(side="true")}) WHERE {where}
      UNION ALL SELECT *, 2 AS source FROM ({_chosen(side="false")}) WHERE {where})
      ORDER BY source, win_start DESC, greenhouse LIMIT 1"""


def _object(*fields: tuple[str, str, bool]) -> str:
    """JSON object as concatenated SQL: (name, value, is text); null fields are left out."""
    parts = []
    for name, value, text in fields:
        quote = '"' if text else ""
        parts.append(f"""CASE WHEN ({value}) IS NOT NULL THEN '"{name}":{quote}' || ({value}) || '{quote}' END""")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')"


_REASON = _object(("score", "score", False), ("reason", "reason", True), ("detail", "detail", True))
_WINDOW_OBJECT = _object(
    ("gh", "greenhouse", True),
    ("temp", "avg_temp", False),
    ("hum", "avg_humidity", False),
    ("soil", "avg_soil_humidity", False),
    ("light", "max_light", False),
    ("win_start", _time("win_start"), True),
    ("win_end", _time("win_end"), True),
    ("recent_high_count", "recent_hot", False),
)
_PREV_OBJECT = _object(
    *[(f, f"prev.{f}", False) for f in ("temp", "hum", "soil", "light")], ("win_start", _time("prev.win_start"), True)
)
PAYLOAD = {
    "told": f"SELECT *, {_REASON} AS j FROM ranked",
    "folded": """SELECT greenhouse, win_start, any_value(win_end) AS win_end, any_value(avg_temp) AS avg_temp,
        any_value(avg_humidity) AS avg_humidity, any_value(avg_soil_humidity) AS avg_soil_humidity,
        any_value(max_light) AS max_light, any_value(prev) AS prev, any_value(recent_hot) AS recent_hot,
        max(score) AS score, string_agg(j, ',' ORDER BY rank) AS reasons, any_value(j) FILTER (rank = 1) AS main,
        coalesce(string_agg(j, ',' ORDER BY rank) FILTER (rank > 1), '') AS rest
      FROM told GROUP BY greenhouse, win_start""",
}
PAYLOAD_ROWS = "SELECT greenhouse, win_start, " + _object(
    ("ok", "'true'", False),
    ("window", _WINDOW_OBJECT, False),
    ("prev_window", f"CASE WHEN prev IS NOT NULL THEN {_PREV_OBJECT} END", False),
    ("reasons", "'[' || reasons || ']'", False),
    ("primary", "main", False),
    ("secondary", "'[' || rest || ']'", False),
    ("confidence", "score", False),
) + " AS value FROM folded"

PAIR_OBJECT = _object(
    ("greenhouse", "greenhouse", True),
    ("win_start", _iso("win_start"), True),
    ("win_end", _iso("win_end"), True),
    *[(f"{p}_{n}", f"{p}_{n}", False) for n in m.SHORT.values() for p in ("left", "right", "diff")],
)
HEALTH_OBJECT = _object(("windows", "windows", False), ("last", _iso("last"), True), ("alive", "alive", False))


AT = f"SELECT * FROM ({_chosen()}) WHERE win_start = (SELECT min(win_start) FROM r WHERE avg_temp > 30)"

ALARMS = {
    "previous_window": q(
        """SELECT greenhouse, win_start, prev.win_start AS prev_start, prev.temp AS prev_temp, prev.hum AS prev_hum,
       prev.soil AS prev_soil, prev.light AS prev_light FROM h""",
        **_history("l", None),
    ),
    "recent_hot_count": q("SELECT greenhouse, win_start, p_avg_temp AS avg_temp, recent_hot FROM h", **_history("l", None)),
    "look_back_two_tables": q(
        """SELECT greenhouse, win_start, coalesce(p_avg_temp, b_avg_temp) AS avg_temp, prev.win_start AS prev_start,
       prev.temp AS prev_temp, recent_hot FROM h""",
        **_history("c", "r"),
    ),
    "alarm_reasons": alarm_sql(REASON_ROWS, "l", None),
    "alarm_reasons_two_tables": alarm_sql(REASON_ROWS, "c", "r"),
    "alarm_primary": alarm_sql(BRIEF, "l", None),
    "alarm_payload": q(PAYLOAD_ROWS, **_history("l", None), alarm=_chosen(), **_reasons(), **PAYLOAD),
    "compare_payload": q(
        f"""SELECT 'aligned' AS section, {PAIR_OBJECT} AS value, NULL::varchar AS current_gh FROM pairs
UNION ALL SELECT 'left', {HEALTH_OBJECT}, NULL FROM (SELECT count(DISTINCT win_start) AS windows, max(win_end) AS last, {ALIVE} AS alive FROM l)
UNION ALL SELECT 'right', {HEALTH_OBJECT}, NULL FROM (SELECT count(DISTINCT win_start) AS windows, max(win_end) AS last, {ALIVE} AS alive FROM r)""",
        **aligned(label(), label()),
    ),
    "alarm_at_window": alarm_sql(BRIEF, "c", "r", AT),
    "alarm_latest": alarm_sql(BRIEF, "c", "r", _latest()),
    "alarm_latest_one": alarm_sql(BRIEF, "c", "r", _latest("greenhouse = '大棚三'")),
}

# ---------------------------------------------------------------- reports


def _means(prefix: str = "mean_") -> str:
    return (
        f"{rnd('avg(avg_temp)', 4)} AS {prefix}temp, {rnd('avg(avg_humidity)', 4)} AS {prefix}humidity, "
        f"{rnd('avg(max_light)', 4)} AS {prefix}max_light"
    )


def _versus(rows: str, name: str) -> str:
    def mean(c: str, g: str) -> str:
        return rnd(f"avg({c}) FILTER ({name} = '{g}')", 4)

    cols = ", ".join(
        f"{mean(c, g)} AS {out}_{i}"
        for i, g in enumerate(m.LABELS[:2], 1)
        for c, out in (("avg_temp", "temp"), ("avg_humidity", "humidity"), ("max_light", "light"))
    )
    return f"""SELECT '大棚一' AS gh1, '大棚二' AS gh2, *, {rnd("temp_1 - temp_2", 4)} AS diff_temp,
       CASE WHEN {rnd("temp_1 - temp_2", 4)} > 0 THEN '高' ELSE '低' END AS verdict FROM (SELECT {cols} FROM {rows})"""


def _exported(rows: str, name: str, newest: str = "") -> str:
    cols = [
        f"coalesce({name}, '')",
        "strftime(win_start, '%Y-%m-%d %H:%M:%S')",
        "strftime(win_end, '%Y-%m-%d %H:%M:%S')",
        *[rnd(s, 2) for s in m.STATS],
    ]
    return (
        "SELECT "
        + ", ".join(f'{c} AS "{h}"' for c, h in zip(cols, m.EXPORT_HEADER))
        + f" FROM {rows} ORDER BY {rows}.win_start DESC, greenhouse_id {newest}"
    )


def _count(name: str, where: str) -> str:
    return f"SELECT '{name}' AS greenhouse, count(*) AS n, {rnd('avg(avg_temp)', 4)} AS mean_temp, {rnd('max(avg_temp)', 4)} AS max_temp FROM l WHERE avg_temp > 30 AND {where}"


_LATEST = f"SELECT {{name}} AS greenhouse, win_start, {STATS} FROM {{rows}} QUALIFY row_number() OVER (PARTITION BY {{name}} ORDER BY win_start DESC) = 1"

REPORTS = {
    "alarm_count": q(_count("所有大棚", "true") + " UNION ALL " + _count("大棚二", "greenhouse_id = 'gh_02'")),
    "alarm_top": q(f"SELECT {label()} AS greenhouse, greenhouse_id, count(*) AS n FROM l WHERE avg_temp > 30 GROUP BY ALL"),
    "alarm_top_synthetic": q(f"SELECT {synth('win_start')} AS greenhouse, count(*) AS n FROM l WHERE avg_temp > 30 GROUP BY ALL"),
    "gh_rank": q(
        f"SELECT {label()} AS greenhouse, greenhouse_id, {_means()}, max(win_start) AS last_start FROM l GROUP BY greenhouse_id"
    ),
    "report_source": q(
        f"SELECT {label()} AS greenhouse, greenhouse_id, {_means()}, max(win_start) AS last_start, true AS real_keys FROM r GROUP BY greenhouse_id"
    ),
    "gh_rank_synthetic": q(
        f"""SELECT (x.ord)::int AS ord, x.g AS greenhouse, s.mean_temp, s.mean_humidity, s.mean_max_light
FROM (VALUES {", ".join(f"({i}, '{g}')" for i, g in enumerate(m.LABELS))}) AS x(ord, g)
LEFT JOIN (SELECT {synth('win_start')} AS greenhouse, {_means()} FROM
  (SELECT win_start, avg(avg_temp) AS avg_temp, avg(avg_humidity) AS avg_humidity, avg(max_light) AS max_light
   FROM l GROUP BY win_start) GROUP BY 1) s ON s.greenhouse = x.g"""
    ),
    "gh_latest": q(_LATEST.format(name=label(), rows="l")),
    "gh_latest_synthetic": q(_LATEST.format(name=synth("win_start"), rows="one")),
    "gh_compare": q(_versus("l", label())),
    "gh_compare_synthetic": q(_versus("one", synth("win_start"))),
    "newest_windows": q(_exported("r", label(), "LIMIT 100")),
    "window_export": q(_exported("r", label())),
    "window_export_synthetic": q(_exported("one", synth("win_start"))),
}

# ---------------------------------------------------------------- questions


def _has(words) -> str:
    return "(" + " OR ".join(f"contains(q, '{w}')" for w in words) + ")"


_TEMPLATES = f"""
SELECT 'e' || event_id AS q_id, CASE event_type
  WHEN 'error' THEN '为什么会高温'
  WHEN 'view' THEN names[user_id % 3 + 1] || '最近温度多少'
  WHEN 'click' THEN names[user_id % 3 + 1] || '与' || names[(user_id + 1) % 3 + 1]
  WHEN 'purchase' THEN names[user_id % 3 + 1] || '有多少次告警'
  ELSE ['哪个大棚告警最多', 'Spark 和 Flink 差异', '各大棚平均温度排行', '你好'][user_id % 4 + 1] END AS q
FROM (SELECT *, [{quoted(*m.LABELS)}] AS names FROM events)
UNION ALL
SELECT 'c-' || conv_id || '-' || turn, text FROM conversations"""

_FIRST = "CASE " + " ".join(f"WHEN {_has(w)} THEN '{g}'" for g, w in m.GREENHOUSE_WORDS.items()) + " END"
_SECOND = "CASE " + " ".join(f"WHEN {_has(w)} AND g1 <> '{g}' THEN '{g}'" for g, w in m.GREENHOUSE_WORDS.items()) + " END"

ASKED = {
    "questions": _TEMPLATES,
    "q0": f"SELECT q_id, coalesce(trim(q, '{m.BLANKS}'), '') AS q FROM questions",
    "q1": f"SELECT q_id, q, {_FIRST} AS g1 FROM q0",
    "q2": f"SELECT *, {_SECOND} AS g2 FROM q1",
    "q3": f"""SELECT *, CASE
  WHEN q = '' THEN 'empty'
  WHEN {_has(m.CAUSE_WORDS)} AND {_has(m.HEAT_WORDS)} THEN 'alarm_reason'
  WHEN {_has(m.ENGINE_WORDS).replace("(q,", "(lower(q),")} AND {_has(m.DIFFERENCE_WORDS).replace("(q,", "(lower(q),")} THEN 'engine_diff'
  WHEN {_has(m.ALARM_WORDS)} THEN CASE WHEN {_has(m.TOP_WORDS)} THEN 'alarm_top' ELSE 'alarm_count' END
  WHEN {_has(m.RANK_WORDS)} AND {_has(m.SUBJECT_WORDS)} THEN 'gh_rank'
  WHEN g1 IS NOT NULL AND {_has(m.LATEST_WORDS)} THEN 'gh_latest'
  WHEN g2 IS NOT NULL AND {_has(m.AND_WORDS)} THEN 'gh_compare'
  ELSE 'unknown' END AS intent FROM q2""",
    "routed": """SELECT q_id, q, intent, CASE WHEN intent IN ('alarm_count', 'gh_latest', 'gh_compare') THEN g1 END AS gh1,
      CASE WHEN intent = 'gh_compare' THEN g2 END AS gh2 FROM q3""",
}


def _counted(name: str) -> str:
    return (
        f"{name} || '：' || count(*) || ' 次高温告警，平均温度 ' || {fmt('avg(avg_temp)', 1)} || '℃，最高 ' || "
        f"{fmt('max(avg_temp)', 1)} || '℃'"
    )


_NAMED = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{g}')" for i, g in enumerate(m.LABELS)) + ") AS n(ord, greenhouse)"
_MEANS = {"temp": "avg_temp", "humidity": "avg_humidity", "light": "max_light"}


def _fact_parts(source: str, greenhouse: str, real: bool) -> dict[str, str]:
    """Facts by plain grouping: rows per greenhouse, means per start, newest row by ranking."""
    hot = f"FROM {source} WHERE avg_temp > 30"
    own = "own" if real else "every"
    rank = "by_row" if real else "by_start"
    means = lambda t, c: ", ".join(f"{rnd(f'avg({v})', 4)} AS {c}_{k}" for k, v in t.items())
    return {
        "shown": f"SELECT {greenhouse} AS greenhouse, * EXCLUDE (greenhouse_id) FROM {source}",
        "own": "SELECT greenhouse, count(*) AS hot_n, avg(avg_temp) AS hot_mean, max(avg_temp) AS hot_max FROM shown WHERE avg_temp > 30 GROUP BY 1",
        "every": f"SELECT g.greenhouse, t.* FROM (SELECT count(*) AS hot_n, avg(avg_temp) AS hot_mean, max(avg_temp) AS hot_max {hot}) t, "
        "(SELECT DISTINCT greenhouse FROM shown) g",
        "by_row": f"SELECT greenhouse, count(*) AS windows, max(win_start) AS last_start, {means(_MEANS, 'mean')} FROM shown GROUP BY 1",
        "starts": "SELECT greenhouse, win_start, " + ", ".join(f"avg({v}) AS mean_{k}" for k, v in _MEANS.items()) + " FROM shown GROUP BY 1, 2",
        "by_start": f"SELECT greenhouse, {means({k: f'mean_{k}' for k in _MEANS}, 'mean')} FROM starts GROUP BY 1",
        "newest": f"SELECT * FROM shown QUALIFY row_number() OVER (PARTITION BY greenhouse ORDER BY win_start DESC, {', '.join(f'{x} DESC' for x in m.STATS)}) = 1",
        "facts": f"""SELECT '{"real" if real else "synthetic"}' AS mode, greenhouse, ord, coalesce(by_row.windows, 0) AS windows, coalesce(h.hot_n, 0) AS hot_n,
              {rnd("h.hot_mean", 4)} AS hot_mean, {rnd("h.hot_max", 4)} AS hot_max, coalesce(own.hot_n, 0) AS ranked_hot,
              {", ".join(f"by_row.mean_{k}" for k in _MEANS)}, {", ".join(f"k.mean_{x} AS rank_{x}" for x in _MEANS)}, by_row.last_start,
              {", ".join(f"{rnd(f'newest.{x}', 4)} AS last_{x}" for x in m.STATS)}
            FROM by_row FULL JOIN ({_NAMED}) USING (greenhouse) LEFT JOIN {own} h USING (greenhouse) LEFT JOIN own USING (greenhouse)
                 LEFT JOIN {rank} k USING (greenhouse) LEFT JOIN newest USING (greenhouse)
            UNION ALL SELECT '{"real" if real else "synthetic"}', NULL, NULL, (SELECT count(*) FROM {source}), count(*), {rnd("avg(avg_temp)", 4)},
              {rnd("max(avg_temp)", 4)}, count(*), NULL, NULL, NULL, NULL, NULL, NULL, (SELECT max(win_start) FROM {source}), NULL, NULL, NULL, NULL {hot}""",
    }


_G = label()
LINES = f"""
SELECT 'alarm_count' AS intent, {_G} AS gh1, NULL::varchar AS gh2, 0.0::double AS sort_value, {_counted(_G)} AS line
FROM l WHERE avg_temp > 30 GROUP BY {_G}
UNION ALL SELECT 'alarm_count', NULL, NULL, 0, {_counted("'所有大棚'")} FROM l WHERE avg_temp > 30
UNION ALL SELECT 'alarm_top', NULL, NULL, -count(*), {_G} || '：' || count(*) || ' 次高温告警' FROM l WHERE avg_temp > 30 GROUP BY {_G}
UNION ALL SELECT 'gh_rank', NULL, NULL, -{rnd("avg(avg_temp)", 4)}, {_G} || '（截止 ' || strftime(max(win_start), '%H:%M:%S') || '）: 均温 ' ||
  {fmt("avg(avg_temp)", 1)} || '℃ · 均湿 ' || {fmt("avg(avg_humidity)", 1)} || '% · 光照 ' || {fmt("avg(max_light)", 0)} || ' lux' FROM l GROUP BY {_G}
UNION ALL SELECT 'gh_latest', {_G}, NULL, 0, {_G} || ' 最新窗口（' || strftime(win_start, '%Y-%m-%d %H:%M:%S') || '）: 温度 ' || {fmt("avg_temp", 1)} ||
  '℃ · 湿度 ' || {fmt("avg_humidity", 1)} || '% · 土壤湿度 ' || {fmt("avg_soil_humidity", 1)} || '% · 光照 ' || {fmt("max_light", 0)} || ' lux'
  FROM (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY greenhouse_id ORDER BY win_start DESC) = 1)
UNION ALL SELECT 'gh_compare', x.g, y.g, 0, x.g || CASE WHEN d > 0 THEN ' 高于 ' ELSE ' 低于 ' END || y.g || '，相差 ' || {fmt("abs(d)", 1)} || '℃'
  FROM per x, per y, LATERAL (SELECT {rnd("x.t - y.t", 4)} AS d) WHERE x.k < y.k
UNION ALL SELECT 'engine_diff', NULL, NULL, 0, 'Spark: ' || lw || ' 窗口 · ' || la || '；Flink: ' || rw || ' 窗口 · ' || ra || '；对齐窗口: ' ||
  (SELECT count(*) FROM pairs) || '；平均温度偏差: ' || (SELECT {fmt("avg(diff_temp)", 2)} FROM pairs) || '℃'
  FROM (SELECT count(DISTINCT win_start) AS lw, CASE WHEN {ALIVE} THEN '运行中' ELSE '离线' END AS la FROM l),
       (SELECT count(DISTINCT win_start) AS rw, CASE WHEN {ALIVE} THEN '运行中' ELSE '离线' END AS ra FROM r)
UNION ALL SELECT 'alarm_reason', NULL, NULL, 0, string_agg(CASE WHEN rank = 1 THEN greenhouse || ' 主因：' || reason || '（置信度 ' || score || '%）；' || detail
  ELSE '次要：' || reason || '（' || score || '%）' END, '；' ORDER BY rank) FROM ranked"""

# greenhouses without a hot window, and those a question can name without any window
NO_LINES = f"""
SELECT 'alarm_count' AS intent, greenhouse AS gh1, NULL::varchar AS gh2, 0.0::double AS sort_value, greenhouse || '：0 次高温告警' AS line
FROM (SELECT greenhouse FROM ({_NAMED}) UNION SELECT {_G} FROM l WHERE greenhouse_id IS NOT NULL)
WHERE greenhouse NOT IN (SELECT {_G} FROM l WHERE avg_temp > 30 AND greenhouse_id IS NOT NULL)
UNION ALL SELECT 'alarm_count', NULL, NULL, 0, '所有大棚：0 次高温告警' WHERE NOT EXISTS (SELECT * FROM l WHERE avg_temp > 30)
UNION ALL SELECT 'gh_latest', greenhouse, NULL, 0, '暂无数据' FROM absent
UNION ALL SELECT 'gh_compare', x.greenhouse, y.greenhouse, 0, '暂无数据' FROM ({_NAMED}) x, ({_NAMED}) y
WHERE x.ord < y.ord AND (x.greenhouse IN (FROM absent) OR y.greenhouse IN (FROM absent))"""

FACTS, FACTS_BY_TIME = _fact_parts("l", _G, True), _fact_parts("l", synth("win_start"), False)

RANKINGS = """SELECT 'alarm_top' AS answer_key, greenhouse, -ranked_hot::double AS sort_value, ranked_hot AS n, NULL::double AS temp,
       NULL::double AS humidity, NULL::double AS light, NULL::timestamp AS last_start FROM facts WHERE greenhouse IS NOT NULL AND ranked_hot > 0
UNION ALL SELECT 'gh_rank', greenhouse, CASE WHEN mode = 'real' THEN -rank_temp ELSE ord END, windows, rank_temp, rank_humidity, rank_light, last_start
FROM facts WHERE greenhouse IS NOT NULL AND (mode = 'synthetic' OR windows > 0)"""

_HELP = "ask for the newest window of a greenhouse, two greenhouses, hot windows, rankings, the engines or a cause"
_ENGINES = f"""(SELECT 'left ' || lw || ' windows (' || la || '), right ' || rw || ' windows (' || ra || '), ' || (SELECT count(*) FROM pairs) ||
  ' pairs, mean difference ' || (SELECT {fmt("avg(diff_temp)", 2)} FROM pairs)
  FROM (SELECT count(DISTINCT win_start) AS lw, CASE WHEN {ALIVE} THEN 'up' ELSE 'down' END AS la FROM l),
       (SELECT count(DISTINCT win_start) AS rw, CASE WHEN {ALIVE} THEN 'up' ELSE 'down' END AS ra FROM r))"""
_CAUSE = f"""(SELECT string_agg(CASE WHEN rank = 1 THEN greenhouse || ' at ' || {fmt("avg_temp", 1)} || ': ' ELSE '' END || reason || ' ' || score || '%' ||
  CASE WHEN rank = 1 THEN ', ' || detail ELSE '' END, '; ' ORDER BY rank) FROM ranked WHERE rank <= 3)"""


def _answer_sql(engines: str, cause: str) -> str:
    env = lambda g, t: f"""coalesce({g} || ': temperature ' || {fmt(f"{t}.mean_temp", 1)} || ', humidity ' || {fmt(f"{t}.mean_humidity", 1)} ||
      ', light ' || {fmt(f"{t}.mean_light", 0)}, {g} || ': no data')"""  # noqa: E731
    return f"""SELECT q_id, q, intent, gh1, gh2, (SELECT max(mode) FROM facts) AS mode,
      CASE WHEN intent IN ('alarm_top', 'gh_rank') THEN intent END AS answer_key,
      CASE intent
        WHEN 'alarm_count' THEN coalesce(gh1, 'all greenhouses') || CASE WHEN a.hot_n > 0 THEN ': ' || a.hot_n || ' hot windows, mean ' ||
          {fmt("a.hot_mean", 1)} || ', highest ' || {fmt("a.hot_max", 1)} ELSE ': no hot window' END
        WHEN 'gh_latest' THEN coalesce(gh1 || ' at ' || strftime(a.last_start, '%Y-%m-%d %H:%M:%S') || ': temperature ' || {fmt("a.last_avg_temp", 1)} ||
          ', humidity ' || {fmt("a.last_avg_humidity", 1)} || ', soil ' || {fmt("a.last_avg_soil_humidity", 1)} || ', light ' || {fmt("a.last_max_light", 0)}, gh1 || ': no data')
        WHEN 'gh_compare' THEN concat_ws('; ', {env("gh1", "a")}, {env("gh2", "b")}, 'difference ' || {fmt("a.mean_temp - b.mean_temp", 1)})
        WHEN 'engine_diff' THEN {engines} WHEN 'alarm_reason' THEN {cause} WHEN 'unknown' THEN '{_HELP}' END AS answer,
      CASE WHEN intent = 'empty' THEN 'empty question' END AS error
    FROM routed LEFT JOIN facts a ON a.greenhouse IS NOT DISTINCT FROM gh1 LEFT JOIN facts b ON b.greenhouse = gh2"""


def _asked(body: str, **more: str) -> str:
    return q(body, **ASKED, **more)


# the comparison's side tables are renamed, the alarm history uses the same short names
_RENAMED = (
    ("FROM a JOIN b", "FROM e_a a JOIN e_b b"),
    ("FROM ra JOIN rb", "FROM e_ra ra JOIN e_rb rb"),
    *((f"FROM {t} {x}", f"FROM e_{t} {x}") for t in "ab" for x in "xy"),
)


def _renamed(sql: str) -> str:
    for old, new in _RENAMED:
        sql = sql.replace(old, new)
    return sql


_PAIRS = {("pairs" if k == "pairs" else f"e_{k}"): _renamed(v) for k, v in aligned(label(), label()).items()}

ANSWERS = _PAIRS | _history("c", "r") | _reasons() | {
    "alarm": _latest(),
}
_ORDER = ("e_a", "e_b", "e_ra", "e_rb", "pairs", "p", "b", "sided", "seen", "h", "alarm", "hits", "scored", "ranked")
ANSWERS = {k: ANSWERS[k] for k in _ORDER}
ALL_LINES = ANSWERS | {
    "per": f"SELECT greenhouse_id AS k, {_G} AS g, {rnd('avg(avg_temp)', 4)} AS t FROM l GROUP BY ALL",
    "lines": LINES,
    "absent": f"SELECT greenhouse FROM ({_NAMED}) WHERE greenhouse NOT IN (SELECT {_G} FROM l WHERE greenhouse_id IS NOT NULL)",
}

RECORDS = """SELECT *, CASE WHEN intent NOT IN ('unknown', 'empty') THEN concat_ws('|', intent, gh1, gh2) END AS answer_key,
       CASE WHEN intent = 'empty' THEN 'empty question' END AS error FROM routed"""


def _escaped(c: str) -> str:
    return f"substr(to_json({c})::varchar, 2, length(to_json({c})::varchar) - 2)"


_RECORD = _object(*[(c, _escaped(c), True) for c in ("q_id", "q", "intent", "gh1", "gh2", "answer_key", "error")])

QUESTIONS = {
    "route_questions": _asked("SELECT * FROM routed"),
    "question_records": _asked(f"SELECT *, {_RECORD} AS record FROM records", records=RECORDS),
    "answers": q(f"SELECT * FROM lines WHERE line IS NOT NULL UNION ALL ({NO_LINES})", **ALL_LINES),
    "answer_facts": q("SELECT * FROM facts", **FACTS),
    "answers_synthetic": q("SELECT * FROM facts", **FACTS_BY_TIME),
    "answer_rankings": q(RANKINGS, **FACTS),
    "answer_rankings_synthetic": q(RANKINGS, **FACTS_BY_TIME),
    "answer_questions": _asked(f"SELECT * EXCLUDE (q) FROM ({_answer_sql(_ENGINES, _CAUSE)})", **ANSWERS, **FACTS),
    "answer_questions_synthetic": _asked(f"""SELECT * EXCLUDE (q) FROM ({_answer_sql("'no data'", "'no hot window'")})""", **FACTS_BY_TIME),
    "answer_records": _asked(
        f"SELECT q_id, {_object(*[(c, _escaped(c), True) for c in ('q_id', 'q', 'intent', 'mode', 'answer_key', 'answer', 'error')])} AS record "
        f"FROM ({_answer_sql(_ENGINES, _CAUSE)})",
        **ANSWERS,
        **FACTS,
    ),
}

# ---------------------------------------------------------------- streams

_CLOSED = "WHERE win_end <= (SELECT t FROM now) - INTERVAL 10 SECOND"

# A replay: rows come with their six days, or one or two micro-batches later. The watermark of a
# micro-batch is two days before the newest row of all micro-batches before it, in milliseconds; a
# row is late if its window ends at or before it.
REPLAY = {
    "dealt": """SELECT *, CASE WHEN event_id % 11 = 5 THEN 2 WHEN event_id % 7 = 3 THEN 1 ELSE 0 END
                  + date_diff('day', DATE '2024-01-01', event_time::date) // 6 AS batch FROM readings""",
    "tops": "SELECT batch, count(*) AS n, max(epoch_us(event_time) // 1000) AS top FROM dealt GROUP BY batch",
    "marks": """SELECT batch, n, row_number() OVER (ORDER BY batch) - 1 AS batch_id,
                  coalesce(max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 172800000, 0) AS mark FROM tops""",
    "judged": """SELECT d.*, marks.batch_id, epoch_us(date_trunc('hour', event_time) + INTERVAL 1 HOUR) // 1000 <= mark AS late
                 FROM dealt d JOIN marks USING (batch)""",
    "intime": "SELECT * FROM judged WHERE NOT late",
}
_IN_TIME = q(
    "SELECT * FROM w WHERE epoch_us(win_end) // 1000 <= (SELECT max(top) FROM tops) - 172800000",
    **REPLAY,
    w=_plain("intime"),
)

STREAMS = {
    "stream_tumbling_avg_max": q(f"SELECT * FROM l {_CLOSED}"),
    "stream_tumbling_trimmed": q(f"SELECT * FROM r {_CLOSED}"),
    "stream_sliding_avg": SLIDING,
    "stream_late_rows": _IN_TIME,
    "stream_resume": _IN_TIME,
    "stream_late_counts": q(
        """SELECT batch_id, n, (SELECT count(DISTINCT (greenhouse_id, date_trunc('hour', event_time))) FROM judged
                               WHERE judged.batch = marks.batch AND late) AS late_groups FROM marks""",
        **REPLAY,
    ),
    "stream_upsert": q("SELECT * FROM r"),
    "stream_table_and_feed": q("SELECT * FROM l"),
    "feed_consumed": q(
        """SELECT greenhouse_id, win_end AS ts, avg_temp AS air_temp_avg, avg_humidity AS air_humidity_avg,
                  avg_soil_humidity AS soil_humidity_avg, max_light AS light_avg FROM l"""
    ),
    "stream_processing_time": q(
        """SELECT greenhouse_id, win_start, win_start + INTERVAL 5 SECOND AS win_end, sum(air_temp)::double / count(*) / 100 AS avg_temp,
                  sum(air_humidity)::double / count(*) / 100 AS avg_humidity, sum(soil_humidity)::double / count(*) / 100 AS avg_soil_humidity,
                  max(light)::double / 100 AS max_light, count(*) AS n
           FROM (SELECT *, to_timestamp(epoch(TIMESTAMP '2024-02-01') + 3 * batch_id // 5 * 5)::timestamp AS win_start FROM judged)
           GROUP BY greenhouse_id, win_start""",
        **REPLAY,
    ),
}

ORACLE: dict[str, str] = INGEST | WINDOWS | TABLES | COMPARE | ALARMS | REPORTS | QUESTIONS | STREAMS
