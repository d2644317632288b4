"""Personal data: base patterns, and a skip-chain conditional random field that adds spans.

Base spans (email, ip, card, phone) come from patterns with checks and always stay. Sites of the
field are the runs without blanks that hold a digit or ``@``. Their labels are ``O`` or a kind.

* Node potentials: log-linear in the site's shape, the logs of smoothed label shares per shape,
  clipped at NODE_MOST. The table of (shape, label, count) is counted over all documents; shapes
  are codes below SHAPES_MOST, so what is collected and broadcast is bounded.
* Chain potentials join a site to the next one if only blanks lie between.
* Skip potentials join a site to the first like it in the document, preferring one in a base span:
  the same letters and digits, the same digits, the last seven digits, or the same name before
  ``@``. One partner per likeness, so the number of edges follows the number of sites.

Labels to learn from are the base spans. A site that is like one in a base span, but is in none,
is unlabelled: it teaches nothing. In a text, sites in base spans are observed; ROUNDS of loopy
message passing reach the others, and what is then likelier a kind than all else becomes a span if
edges lead from it to an observed site. A text without base spans gets none.

Defined cases: null and empty texts have no span; repeated rows and ids each get their row; texts
of any length are read whole, in time that follows their length; an empty table gives an empty
one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from verdance.llm.common import fresh, small_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)
ROUNDS = 20
#: Prior counts of skip edges: like sites that agree, and that do not.
AGREE, DIFFER = 50.0, 1.0
#: Prior counts of a shape's labels, and the most that a shape may weigh against edges.
PRIOR, NODE_MOST = np.array([3.6, 0.1, 0.1, 0.1, 0.1]), 5.0
#: Digits at the end that make two numbers alike.
TAIL = 7
SHAPES_MOST = 21 * 6 * 5 * 3 * 4 * 3 * 2**5

Span = tuple[str, int, int]

# The base patterns, in forms that never go back over a run.
_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SITE = re.compile(r"[^\x20\x09-\x0D]+")
_SIGNAL = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: each ``@`` with the run of name signs before it and the host after."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        found = _AFTER_AT.match(text, at) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        else:
            done = max(done, at)  # the run before this sign can belong to no later match
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by start, then kind as listed; code points, the end exclusive."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if _SIGNAL.search(text):
        for m in _IP.finditer(text):
            if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups()):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- sites and their graph -----------------------------------------------------------------------


class Sites:
    """Sites of one text: places, shapes, labels seen, and edges."""

    def __init__(self, text: str, base: list[Span]):
        self.places = [(m.start(), m.end()) for m in _SITE.finditer(text) if _SIGNAL.search(m.group())] if _SIGNAL.search(text) else []
        words = [text[a:b] for a, b in self.places]
        self.seen = np.zeros(len(words), np.int8)
        at = 0
        for kind, a, b in sorted(base, key=lambda s: s[1]):
            while at < len(words) and self.places[at][1] <= a:
                at += 1
            i = at
            while i < len(words) and self.places[i][0] < b:
                if not self.seen[i]:
                    self.seen[i] = 1 + KINDS.index(kind)
                i += 1
        self.shapes = [shape(w) for w in words]
        gaps = [text[self.places[i][1] : self.places[i + 1][0]] for i in range(len(words) - 1)]
        self.chain = np.array([i for i, g in enumerate(gaps) if not _SITE.search(g)], np.int64)
        self.skip = self._likeness(words)

    def _likeness(self, words: list[str]) -> np.ndarray:
        groups: dict[tuple, list[int]] = {}
        for i, w in enumerate(words):
            for key in keys(w):
                groups.setdefault(key, []).append(i)
        edges = set()
        for members in groups.values():
            if len(members) > 1:
                first = next((i for i in members if self.seen[i]), members[0])
                edges.update((first, i) for i in members if i != first)
        return np.array(sorted(edges), np.int64).reshape(-1, 2)

    def reached(self) -> np.ndarray:
        """Sites that edges, however many, lead to from an observed one."""
        root = list(range(len(self.seen)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, b in [*zip(self.chain.tolist(), (self.chain + 1).tolist(), strict=True), *self.skip.tolist()]:
            root[find(a)] = find(b)
        good = {find(i) for i in np.flatnonzero(self.seen).tolist()}
        return np.array([find(i) in good for i in range(len(root))], bool)

    def labelled(self) -> np.ndarray:
        """Sites to learn from: not those like an observed one without being observed."""
        out = np.ones(len(self.seen), bool)
        for a, b in self.skip:
            if self.seen[a] and not self.seen[b]:
                out[b] = False
        return out


def keys(word: str) -> list[tuple]:
    """What makes two sites alike."""
    bare = "".join(c for c in word.lower() if c.isalnum())
    digits = "".join(c for c in word if c in "0123456789")
    out = [("bare", bare)] if len(bare) >= 4 else []
    if len(digits) >= TAIL:
        out += [("digits", digits), ("tail", digits[-TAIL:])]
    name, _, host = word.partition("@")
    if host and len(name) >= 3:
        out.append(("name", name.lower()))
    return out


def shape(word: str) -> int:
    """A code below SHAPES_MOST: numbers of digits, groups, signs and letters, each cut."""
    digits = sum(c in "0123456789" for c in word)
    groups = len(re.findall(r"[0-9]+", word))
    letters = sum(c.isalpha() for c in word)
    code = 0
    for value, most in (
        (digits, 20), (min(groups, 5), 5), (word.count("."), 4), (word.count("@"), 2), (word.count("-"), 3), (min(letters, 2), 2),
    ):
        code = code * (most + 1) + min(value, most)
    for sign in ("+", "(", "=", '"'):
        code = code * 2 + (sign in word)
    return code * 2 + (14 <= digits <= 19 and luhn("".join(c for c in word if c in "0123456789")))


# --- learning ------------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (what, code, label, label): shapes of sites, and labels on both kinds of edges."""
    held: dict[tuple[str, int, int], int] = {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text or not _SIGNAL.search(text):
                continue
            s = Sites(text, base_spans(text))
            good = s.labelled()
            for i in np.flatnonzero(good):
                held[k] = held.get(k := ("site", s.shapes[i], int(s.seen[i])), 0) + 1
            for what, pairs in (("chain", np.stack([s.chain, s.chain + 1], axis=1)), ("skip", s.skip)):
                for a, b in pairs:
                    if good[a] and good[b]:
                        held[k] = held.get(k := (what, int(s.seen[a]), int(s.seen[b])), 0) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int32()), pa.array([k[2] for k in held], pa.int32()), pa.array(list(held.values()), pa.int64())],
        names=["what", "a", "b", "n"],
    )


def node_potentials(counts: np.ndarray) -> np.ndarray:
    """Log shares of labels, from rows of counts, each at most NODE_MOST below the largest."""
    logs = np.log(counts + PRIOR)
    return np.maximum(logs - logs.max(axis=-1, keepdims=True), -NODE_MOST)


def fit(docs: DataFrame) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """(counts of labels per shape, log chain potentials, log skip potentials), counted over all
    of ``docs``."""
    counts = docs.mapInArrow(_counted, "what string, a int, b int, n long").groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()
    shapes: dict[int, np.ndarray] = {}
    chain, skip = np.ones((LABELS,) * 2), np.full((LABELS,) * 2, DIFFER) + np.eye(LABELS) * (AGREE - DIFFER)
    for what, a, b, n in counts:
        if what == "site":
            shapes.setdefault(a, np.zeros(LABELS))[b] += n
        elif what == "chain":
            chain[a, b] += n
        else:
            skip[a, b] += n
            skip[b, a] += n * (a != b)
    own = lambda c: np.log(c) - (np.log(c.sum(axis=1, keepdims=True)) + np.log(c.sum(axis=0, keepdims=True))) / 2
    return shapes, own(chain), own(skip)


# --- inference -----------------------------------------------------------------------------------


def _normal(m: np.ndarray) -> np.ndarray:
    m = m - m.max(axis=-1, keepdims=True)
    return m - np.log(np.exp(m).sum(axis=-1, keepdims=True))


def posteriors(node: np.ndarray, seen: np.ndarray, edges: np.ndarray, tables: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of sites by loopy message passing, all edges at once in each round.

    node: log potentials; seen: label of observed sites, else 0; edges (a, b); tables: log
    potentials [label of a, label of b] of each edge. Exact on trees no deeper than ``rounds``.
    """
    local = _normal(node)
    held = np.flatnonzero(seen)
    local[held] = -1e4
    local[held, seen[held]] = 0.0
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    table = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.full((len(source), node.shape[1]), -np.log(node.shape[1]))

    table = np.exp(table)

    def belief() -> np.ndarray:
        return local + np.stack([np.bincount(target, m, len(local)) for m in messages.T], axis=1)

    for _ in range(rounds if len(source) else 0):
        cavity = belief()[source] - messages[back]
        cavity = np.exp(cavity - cavity.max(axis=1, keepdims=True))
        messages = _normal(np.log((cavity[:, None, :] @ table)[:, 0] + 1e-300))
    return np.exp(_normal(belief()))


def added(text: str, sites: Sites, probability: np.ndarray) -> list[Span]:
    """Spans of unobserved sites that are likelier one kind than all else; adjacent ones together,
    without the punctuation around them."""
    best = np.where((probability.max(axis=1) > 0.5) & (sites.seen == 0), probability.argmax(axis=1), 0)
    if best.any():
        best[~sites.reached()] = 0
    follows = set(sites.chain.tolist())
    out, i = [], 0
    while i < len(best):
        j = i
        while best[i] and j in follows and best[j + 1] == best[i]:
            j += 1
        if best[i]:
            start, end = sites.places[i][0], sites.places[j][1]
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
                end -= 1
            if start < end:
                out.append((KINDS[best[i] - 1], start, end))
        i = j + 1
    return out


def find_all(texts: list[str | None], model: tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text. Inference runs over the sites of all texts at once."""
    table, chain, skip = model
    bases, graphs, at = [], [], 0
    edges, tables, shapes, seen = [], [], [], []
    for text in texts:
        base = base_spans(text) if text else []
        sites = Sites(text, base) if text and _SIGNAL.search(text) else None
        bases.append(base)
        graphs.append((at, sites))
        if sites is not None and len(sites.seen):
            edges += [np.stack([sites.chain, sites.chain + 1], axis=1) + at, sites.skip + at]
            tables += [np.broadcast_to(chain, (len(sites.chain), LABELS, LABELS)), np.broadcast_to(skip, (len(sites.skip), LABELS, LABELS))]
            shapes += sites.shapes
            seen.append(sites.seen)
            at += len(sites.seen)
    if not at:
        return [(b, []) for b in bases]
    unknown = np.zeros(LABELS)
    nodes = node_potentials(np.array([table.get(s, unknown) for s in shapes]))
    probability = posteriors(nodes, np.concatenate(seen).astype(int), np.concatenate(edges), np.concatenate(tables))
    return [
        (base, added(text, sites, probability[i : i + len(sites.seen)]) if sites is not None else [])
        for text, base, (i, sites) in zip(texts, bases, graphs, strict=True)
    ]


def _found(batches: Iterator[pa.RecordBatch], model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
    for batch in batches:
        out = []
        for base, more in find_all(batch.column(1).to_pylist(), model.value):
            whole = sorted([(*s, True) for s in base] + [(*s, False) for s in more], key=lambda s: (s[1], KINDS.index(s[0])))
            out.append([dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in whole])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, spans)], schema=schema)


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): each row's spans, array of (kind, start, end, base) by start, then kind."""
    small_batches(docs.sparkSession)
    other = fresh([key], "_text")
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(other))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows.select(other)))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
    schema = pa.schema([pa.field(key, to_arrow_type(rows.schema[key].dataType)), pa.field("spans", span)])
    kinds = f"`{key}` {rows.schema[key].dataType.simpleString()}, spans array<struct<kind: string, start: int, end: int, base: boolean>>"
    return rows.mapInArrow(lambda it: _found(it, model, schema), kinds)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): numbers of base
    spans, SHA-256 of the base spans as text, all spans as text, number of added spans."""
    found = personal_spans(docs)
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def _of_kind(kind: str):
    return lambda s: s["base"] & (s["kind"] == kind)
