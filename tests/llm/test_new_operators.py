"""Personal data, whitening and collocations against brute force, on odd rows and on the tables."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from verdance.llm import automata, collocations, personal, whitening

SCHEMA = "doc_id long, text string, lang string, spans string, x long, `range` string, grams string, n long"


def documents(spark, rows):
    """Extra columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "s", 1, "r", "g", 2) for i, t, lang in rows], SCHEMA)


# --- collocations --------------------------------------------------------------------------------


def mined(rows, least, most):
    """(lang, rank, phrase, a, l, r, n, score) by plain counting."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        found = []
        for p, a in candidates.items():
            if 100 * longer[p] < 80 * a:
                cuts = [(2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:most])]
    return sorted(out)


def odd_texts():
    rnd = random.Random(4)
    words = ["the", "The", "of", "a", "b", "é", "ß", "日本", "x-1", "it's", "\x1f", "zz"]
    rows = []
    for i in range(300):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; "]) for _ in range(rnd.randint(0, 60)))
        rows.append((i, text, rnd.choice(["en", "de", None, "", "und"])))
    rows += [(7, "a b a b a b " * 40, "en"), (7, None, "en"), (None, "", None), (None, " \n\t", "en"), (8, "of the x-1 zz", "en")] * 3
    return rows + [(9, "the of " * 50_000 + "end", "fr"), (10, "w" * 300_000 + " the", "fr")]


@pytest.mark.parametrize("bits", [collocations.FILTER_BITS, 64])
def test_collocations(spark, bits, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 3000)  # many shards, also within a task
    monkeypatch.setattr(collocations, "UNION_BYTES", 2000)
    rows = odd_texts()
    docs = documents(spark, rows).repartition(5)
    for least, most in ((2, 2000), (30, 7)):
        got = collocations.collocations(docs, least=least, most=most, filter_bits=bits)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r) for r in got.collect()) == mined([(t, lang) for _, t, lang in rows], least, most)


def test_collocations_without_rows(spark):
    assert collocations.collocations(documents(spark, [(1, "a b", "en")]).where("false")).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, None), (2, "one", "en")])).collect() == []


def test_collocations_beyond_64_bits(spark):
    score = spark.sql("select (cast(2000000 as decimal(10, 0)) * cast(a as decimal(19, 0))) div (l + r) as s from values (9000000000000000000L, 4000000000000000000L, 5000000000000000000L) t(a, l, r)")
    assert score.first()["s"] == 2_000_000


def test_automata():
    rnd = random.Random(1)
    parts, total = [], Counter()
    for _ in range(6):
        counts = Counter(tuple(rnd.choices([b"a", b"b", b"", b"cc", "é".encode(), b"b\0"], k=rnd.randint(1, 4))) for _ in range(300))
        total += counts
        symbols, place = automata.numbered(pa.array([w for g in counts for w in g], pa.binary()))
        grams, at = np.full((len(counts), 4), -1, np.int32), 0
        for i, g in enumerate(counts):
            grams[i, : len(g)] = place[at : at + len(g)]
            at += len(g)
        order = np.lexsort(grams.T[::-1])
        a = automata.build(symbols, grams[order], np.array(list(counts.values()))[order])
        parts.append(automata.Automaton.from_bytes(a.to_bytes()))

    def listed(a):
        names = a.symbols.to_pylist()
        return {tuple(names[p] for p in g if p >= 0): w for g, w in zip(*[x.tolist() for x in a.paths()], strict=True)}

    whole = automata.union(parts)
    assert listed(whole) == total
    assert listed(whole.pruned(5)) == {g: n for g, n in total.items() if n >= 5}
    assert len(whole.first) - 1 < len(total)  # equal continuations are one state
    met, weights = whole.compose(parts[0])
    names = parts[0].symbols.to_pylist()
    assert {tuple(names[p] for p in g if p >= 0): w for g, w in zip(met.tolist(), weights.tolist(), strict=True)} == {g: total[g] for g in listed(parts[0])}
    names, grams = whole.symbols.to_pylist(), np.array(sorted(whole.paths()[0].tolist()), np.int32)
    rows = [tuple(names[p] for p in g if p >= 0) for g in grams.tolist()]
    borders = sorted([*rnd.sample(rows, 20), (b"aa",), (b"b", b"a\0"), (b"zz",), (b"cc", b"", b"b", b"c")])
    assert automata.cuts(names, grams, borders) == [sum(r < b for r in rows) for b in borders]


# --- whitening -----------------------------------------------------------------------------------


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, n long, x string, place int, component string"
    return spark.createDataFrame([(i, v, 5, "x", 1, "c") for i, v in rows], schema)


def held_against(got, rows, most=16):
    """The fit list's moments by numpy; components up to their sign."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    whole = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 1_000_000) for i, v in usable]
    fit = np.array(sorted({tuple(x) for _, x in whole}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = (fit * n - np.array(sums)) / n
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    assert Counter((r["vec_id"], r["component"]) for r in got) == Counter((i, c + 1) for i, _ in whole for c in range(k))
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) <= 1e-8
    far = Counter((i, sum((n * int(a) - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in whole for _ in range(k))
    assert Counter((r["vec_id"], r["deviation"]) for r in got) == far
    for c in range(k):
        own = [r for r in got if r["component"] == c + 1]
        assert all(abs(r["explained"] - values[c] / values.sum()) <= 1e-12 for r in own)
    return whole, fit, n, cov, values, k


def test_whitening(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 20)) * np.linspace(1, 3, 20))]
    rows += rows[:40] + [(None, rows[3][1]), (5, rows[9][1])]
    odd = [(900, None), (901, []), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (904, [None] + [0.0] * 19)]
    table = vectors(spark, rows + odd).repartition(11)  # more triangles than one task stacks
    got = whitening.whiten(table)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    whole, fit, n, cov, values, k = held_against(got, rows + odd)
    assert k == 16
    _, own = np.linalg.eigh(cov)
    own = own[:, ::-1]
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in got if r["vec_id"] not in (None, 5)}
    for c in range(k):
        mine = np.array([by[i, c + 1] for i, _ in whole if i not in (None, 5)])
        want = np.array([(x - fit.sum(axis=0) / n) @ own[:, c] for i, x in whole if i not in (None, 5)]) / np.sqrt(values[c])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8


def test_whitening_of_low_rank_and_none(spark):
    rng = np.random.default_rng(5)
    low = [(i, [float(x) for x in np.repeat(v, 4)]) for i, v in enumerate(rng.integers(-9, 9, size=(50, 3)))]
    held_against(whitening.whiten(vectors(spark, low)).collect(), low)
    few = [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-9, 9, size=(4, 12)))]
    held_against(whitening.whiten(vectors(spark, few)).collect(), few)
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    empty = whitening.whiten(vectors(spark, low).where("false"))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


@pytest.mark.parametrize("kind", ["random", "falling", "rising", "equal", "low rank", "isotropic", "one", "zero"])
def test_bidiagonal_qd(kind):
    rng = np.random.default_rng(0)
    x = {
        "random": rng.normal(size=(500, 48)),
        "falling": rng.normal(size=(500, 40)) * np.logspace(0, -6, 40),
        "rising": rng.normal(size=(500, 40)) * np.logspace(-8, 0, 40),
        "equal": np.vstack([np.eye(30) * 7, -np.eye(30) * 7]),
        "low rank": rng.normal(size=(300, 5)) @ rng.normal(size=(5, 40)),
        "isotropic": np.linalg.qr(rng.normal(size=(300, 20)))[0] * 5,
        "one": rng.normal(size=(30, 1)),
        "zero": np.zeros((9, 6)),
    }[kind]
    values, found, trace = whitening.directions(np.linalg.qr(x, mode="r"), len(x), 64)
    cov = x.T @ x / len(x)
    want = np.linalg.svd(x, compute_uv=False) ** 2 / len(x)
    assert len(values) == {"low rank": 5, "zero": 0}.get(kind, x.shape[1])
    assert abs(trace - np.trace(cov)) <= 1e-12 * max(trace, 1)
    if len(values):
        assert np.abs(values - want[: len(values)]).max() <= 1e-13 * want[0]
        assert np.abs(cov @ found - found * values).max() <= 1e-13 * want[0]
        assert np.abs(found.T @ found - np.eye(len(values))).max() <= 1e-11


def test_qd_keeps_the_digits_of_small_values():
    diagonal, above = np.array([1.0, 1e-4, 1e-8, 1e-12]), np.array([1.0, 1e-4, 1e-8])
    mid = np.linalg.inv(np.diag(diagonal) + np.diag(above, 1))  # exact enough: the matrix is graded
    least = 1 / np.linalg.norm(mid, 2) ** 2
    assert abs(whitening.dqds(diagonal, above)[-1] / least - 1) < 1e-10


# --- personal data -------------------------------------------------------------------------------


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans():
    rnd = random.Random(3)
    parts = ["4111111111111111", "+1", "555", "-", ".", " ", "25", "@", "b", "12", "(499)", "é", "256", "007"]
    for _ in range(20_000):
        for signs, most in (("a.@1-+ (5)_%é0,٣", 30), (parts, 14)):
            text = "".join(rnd.choices(signs, k=rnd.randint(0, most)))
            assert personal.base_spans(text) == base(text), text


CALLS = [(i, f"Call +1 (2{i:02}) 555-{1000 + 7 * i} or mail jo{i}.doe@mail{i}.example.com from 10.0.{i}.7 now", "en") for i in range(40)]
ODD = [
    (100, "Call +1 (499) 555-6503 now. Later (499) 555-6503, and on 2024-01-02 item (3)", "en"),
    (101, "card 4432507379035540 again 4432.5073.7903.5540", "en"),
    (102, "mail hein.19@mail5.example.com or hein.19@localhost", "en"),
    (103, "clean (499) 555-6503 and 4432.5073.7903.5540 on 7.7.2024", "en"),
    (104, None, None), (105, "", "en"), (None, "x 1.2.3.4", "en"), (106, "plain words only", "en"), (106, "plain words only", "en"),
]


def test_personal_data(spark):
    rows = CALLS + ODD
    got = personal.personal_data(documents(spark, rows).repartition(3))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    want = []
    for i, text, _ in rows:
        spans = base(text or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        want.append((i, *[sum(s[0] == k for s in spans) for k in personal.KINDS], digest))
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == sorted(want, key=repr)
    texts, more = {i: t for i, t, _ in rows}, {}
    for r in got.collect():
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert spans == sorted(spans, key=lambda s: (s[1], personal.KINDS.index(s[0])))
        assert set(base(texts[r["doc_id"]] or "")) <= set(spans)
        more[r["doc_id"]] = [(k, texts[r["doc_id"]][a:b]) for k, a, b in spans if (k, a, b) not in base(texts[r["doc_id"]])]
    assert more.pop(100) == [("phone", "(499) 555-6503")]
    assert more.pop(101) == [("card", "4432.5073.7903.5540")]
    assert more.pop(102) == [("email", "hein.19@localhost")]
    assert not any(more.values())
    assert personal.personal_data(documents(spark, rows).where("false")).collect() == []


def test_message_passing():
    """Exact on trees against all labellings; on a loop the same best labels."""
    rng = np.random.default_rng(2)
    for edges in ([(0, 1), (1, 2), (1, 3), (3, 4)], [(0, 4), (4, 2)], [(0, 1), (1, 2), (2, 3), (0, 3)]):
        edges = np.array(edges)
        node, tables = rng.normal(size=(5, 5)), rng.normal(size=(len(edges), 5, 5)) * 0.5
        seen = np.array([2, 0, 0, 0, 0])
        exact = np.zeros((5, 5))
        for labels in itertools.product(range(5), repeat=5):
            if labels[0] == 2:
                p = np.exp(sum(node[i, y] for i, y in enumerate(labels)) + sum(t[labels[a], labels[b]] for (a, b), t in zip(edges, tables, strict=True)))
                exact[np.arange(5), labels] += p
        exact /= exact.sum(axis=1, keepdims=True)
        got = personal.posteriors(node, seen, edges, tables)
        if len(edges) == 4 and (edges[-1] == (0, 3)).all():
            assert (got.argmax(axis=1) == exact.argmax(axis=1)).all() and np.abs(got - exact).max() < 0.05
        else:
            assert np.abs(got - exact).max() < 1e-9


def test_personal_data_in_long_texts():
    model = ({}, np.zeros((5, 5)), np.zeros((5, 5)))
    long = ["9" * 400_000, "1 " * 20_000, "a@" * 200_000, "a" * 400_000 + "@b.c", "+1" + " " * 400_000, "1.2.3.4 " * 10_000, "+1 " * 20_000]
    begin = time.perf_counter()
    found = personal.find_all(long, model)
    assert time.perf_counter() - begin < 60
    assert found[3][0] == [("email", 0, 400_004)] and len(found[5][0]) == 10_000


def test_tables(spark, sf_dir):
    """The registered queries on whole tables."""
    from verdance.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op11_personal_data"](spark, sf_dir).collect():
        spans = base(texts.pop(r["doc_id"]))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    assert not texts
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    held_against(QUERIES["op12_whitening"](spark, sf_dir).collect(), rows)
