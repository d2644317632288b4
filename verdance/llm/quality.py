"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer
network in numpy with temperature-calibrated probabilities.

A word's hash picks one of ROWS rows. Each row has a sparse ternary index vector, and a context
vector: the sum of the index vectors of its words' neighbours within REACH words, added up over
all documents and scaled to length one. No word is left out; those that share a row share its
vectors. The sums of a task and of the whole corpus have ROWS rows whatever the data, so they
are added up before they are shuffled, and the scaled table is broadcast. A document is the mean
of its words' context vectors next to the mean of the index vectors of their shapes (letters
folded to a, A, 0) and of marks for repetition: words that complete a triple seen before, lines
seen before.

Only the network is fitted on a sample: at most TRAIN_MOST different labelled texts, those with
the smallest hash of the id. It learns from four fifths of the sample; the temperature comes
from the rest. Every document is scored over its whole text.

Defined cases: null and empty texts pool to zeros and are scored like that; labels without a
document, null labels and null ids are not learned from; a document with several labels is
learned once for each, repeated rows once; without labels of both kinds every score is the share
of label 1 (0.5 without any); repeated rows are scored one by one.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from verdance.llm.common import forget, fresh, remainder, small_batches, stored

DIMENSIONS, NONZERO, REACH = 64, 6, 2
#: Bound of the labelled sample; rows that words and shapes are hashed into.
TRAIN_MOST, ROWS, SHAPES = 6000, 1 << 16, 4096
#: Words that are added up at once.
STEP = 50_000
HIDDEN, EPOCHS, RATE = 24, 25, 3e-3
#: Scores from here on are predicted as good.
CUT = 0.3
MEMO = 200_000

_run = re.compile(r"(.)\1+", re.S)


class _Fold(dict):
    def __missing__(self, c: int) -> str:
        ch = chr(c)
        self[c] = out = "0" if ch.isdigit() else ch if not ch.isalpha() else "A" if ch.isupper() else "a"
        return out


_fold = _Fold()


def shape(word: str) -> str:
    """'Aa,' for 'Hello,'; runs count once."""
    return _run.sub(r"\1", word.translate(_fold))


def index_vector(name: str) -> np.ndarray:
    """Sparse, ternary, drawn from the hash of the name."""
    out = np.zeros(DIMENSIONS, np.int32)
    for b in hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=NONZERO).digest():
        out[b % DIMENSIONS] = 1 if b >= 128 else -1
    return out


@functools.cache
def _shape_vectors() -> np.ndarray:
    """A row for each bucket of shapes, the last two for repetition of triples and lines."""
    rows = [index_vector(f"shape {i}") for i in range(SHAPES)]
    return np.array([*rows, index_vector("triple seen"), index_vector("line seen")], np.float32)


@functools.cache
def index_table() -> np.ndarray:
    """The index vectors of the rows; row 0 is blank and stands between texts."""
    rng = np.random.default_rng(11)
    out = np.zeros((ROWS, DIMENSIONS), np.int8)
    places = rng.integers(0, DIMENSIONS, (ROWS - 1, NONZERO))
    np.put_along_axis(out[1:], places, rng.integers(0, 2, places.shape, np.int8) * 2 - 1, axis=1)
    return out


def word_rows(hashes: np.ndarray) -> np.ndarray:
    """The rows of words with these 32-bit hashes."""
    return (hashes % (ROWS - 1) + 1).astype(np.uint16)


def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def _grouped(rows: np.ndarray, vectors: np.ndarray, sums: np.ndarray) -> None:
    """Adds each vector to the row it belongs to."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.diff(rows.astype(np.int32), prepend=-1))
    sums[rows[first]] += np.add.reduceat(vectors[order], first, axis=0, dtype=sums.dtype)


def _add_neighbours(rows: np.ndarray, sums: np.ndarray) -> None:
    """Adds to each word's row the index vectors of the words within REACH."""
    index = index_table()
    for at in range(0, len(rows), STEP):
        low, end = max(0, at - REACH), min(len(rows), at + STEP)
        own = rows[low : end + REACH]
        every = index[own]
        around = np.zeros_like(every)
        for d in range(1, REACH + 1):
            around[d:] += every[:-d]
            around[:-d] += every[d:]
        _grouped(own[at - low : end - low], around[at - low : end - low], sums)


def _leave(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = np.flatnonzero(sums[1:].any(axis=1)) + 1
    for at in range(0, len(used), 4096):
        part = used[at : at + 4096]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([v.tobytes() for v in sums[part]], pa.binary())], names=["row", "vector"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, vector): the neighbours' index vectors, summed over a partition."""
    sums, memo = np.zeros((ROWS, DIMENSIONS), np.int32), {}
    between = np.zeros(REACH, np.uint16)
    for batch in batches:
        held, n = [], 0
        for text in batch.column(0).to_pylist():
            words = (text or "").split()
            if not words:
                continue
            for w in set(words).difference(memo):
                memo[w] = _hash(w)
            held += [word_rows(np.fromiter(map(memo.__getitem__, words), np.int64, len(words))), between]
            n += len(words)
            if len(memo) > MEMO:
                memo.clear()
            if n >= STEP:
                _add_neighbours(np.concatenate(held), sums)
                held, n = [], 0
        if held:
            _add_neighbours(np.concatenate(held), sums)
    yield from _leave(sums)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of all partitions, for the rows that came here."""
    sums = np.zeros((ROWS, DIMENSIONS), np.int64)
    for batch in batches:
        if batch.num_rows:
            vectors = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.int32).reshape(-1, DIMENSIONS)
            _grouped(batch.column("row").to_numpy(), vectors, sums)
    yield from _leave(sums)


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The context vectors of all rows, from all texts. At most ROWS rows come to the driver."""
    kinds = "row int, vector binary"
    found = texts.select("text").mapInArrow(_contexts, kinds).repartition("row").mapInArrow(_summed, kinds).collect()
    out = np.zeros((ROWS, DIMENSIONS), np.float32)
    for r in found:
        v = np.frombuffer(r["vector"], np.int64).astype(np.float64)
        out[r["row"]] = v / max(1.0, float(np.linalg.norm(v)))
    return out


class Pooler:
    """Document vectors; remembers shapes and hashes of a bounded number of words."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.shapes, self.memo = vectors, _shape_vectors(), {}

    def _word(self, w: str) -> int:
        """32 bits of hash and the row of the shape in one number."""
        out = _hash(w) | _hash(shape(w)) % SHAPES << 32
        if len(w) <= 64:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[w] = out
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        out = np.zeros(2 * DIMENSIONS, np.float32)
        words = (text or "").split()
        if not words:
            return out
        get = self.memo.get
        packed = np.array([get(w) or self._word(w) for w in words], np.int64)
        n = len(packed)
        rows, times = np.unique(word_rows(packed & 0xFFFFFFFF), return_counts=True)
        out[:DIMENSIONS] = times @ self.vectors[rows] / n
        kinds = np.bincount(packed >> 32, minlength=SHAPES + 2).astype(np.float32)
        h = (packed & 0xFFFFFFFF).astype(np.uint64)
        triples = (h[2:] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[:-2]
        kinds[SHAPES] = len(triples) - len(np.unique(triples))
        lines = text.split("\n")
        kinds[SHAPES + 1] = n * (1 - len(set(lines)) / len(lines))
        used = np.flatnonzero(kinds)
        out[DIMENSIONS:] = kinds[used] @ self.shapes[used] / n
        return out


def _forward(x: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum((x - net["mean"]) / net["std"] @ net["w1"] + net["b1"], 0)
    return hidden, hidden @ net["w2"] + net["b2"]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def probability(x: np.ndarray, net: dict) -> np.ndarray:
    if "constant" in net:
        return np.full(len(x), net["constant"])
    return _sigmoid(_forward(x, net)[1] / net["temperature"])


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> dict:
    """Adam on the log loss, then the temperature with the smallest loss on the held-out fifth."""
    if len(set(y.tolist())) < 2:
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    part = max(1, len(x) // 5)
    own, rest = (order[part:], order[:part]) if len(x) >= 20 else (order, order)
    net = {
        "mean": x[own].mean(axis=0),
        "std": x[own].std(axis=0) + 1e-3,
        "w1": rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
        "b2": 0.0,
    }
    names = ("w1", "b1", "w2", "b2")
    first, second, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(own), max(1, len(own) // 64)):
            step += 1
            z = (x[batch] - net["mean"]) / net["std"]
            hidden, out = _forward(x[batch], net)
            d = (_sigmoid(out) - y[batch]) / len(batch)
            back = np.outer(d, net["w2"]) * (hidden > 0)
            grads = {
                "w1": z.T @ back + 1e-4 * net["w1"],
                "b1": back.sum(axis=0),
                "w2": hidden.T @ d + 1e-4 * net["w2"],
                "b2": d.sum(),
            }
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                net[k] = net[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    z, t = _forward(x[rest], net)[1], y[rest]
    loss = lambda s: -np.mean(t * np.log(_sigmoid(z / s) + 1e-12) + (1 - t) * np.log(1 - _sigmoid(z / s) + 1e-12))
    net["temperature"] = float(min(np.exp(np.linspace(-1, 2.5, 71)), key=loss))
    return net


def _pooled(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    pool = Pooler(shared.value)
    for batch in batches:
        vectors = [pool(t).tobytes() for t in batch.column("text").to_pylist()]
        kept = [batch.column(c) for c in ("id", "digest", "quality")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(vectors, pa.binary())], names=["id", "digest", "quality", "vector"])


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_MOST):
    """(context vectors of all documents, network from at most ``most`` different labelled texts
    that are not held out)."""
    spark = docs.sparkSession
    small_batches(spark)
    vectors = word_vectors(docs)
    shared = spark.sparkContext.broadcast(vectors)
    learnable = labels.where(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id"), 5) != 0))
    learnable = learnable.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    chosen = learnable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    digest = F.xxhash64("text").alias("digest")
    named = docs.select("doc_id", digest).join(F.broadcast(chosen), "doc_id").distinct()
    picked = stored(named.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "digest").limit(most), "picked")
    sample = docs.select("doc_id", digest, "text").join(F.broadcast(picked), ["doc_id", "digest"])
    rows = (
        sample.select(F.xxhash64("doc_id").alias("id"), "digest", "quality", "text")
        .mapInArrow(lambda it: _pooled(it, shared), "id long, digest long, quality int, vector binary")
        .dropDuplicates(["id", "digest", "quality"])
        .collect()
    )
    forget(picked)
    rows.sort(key=lambda r: (bytes(r["vector"]), r["quality"]))
    x = np.array([np.frombuffer(r["vector"], np.float32) for r in rows], np.float64).reshape(len(rows), 2 * DIMENSIONS)
    return vectors, fit_network(x, np.array([r["quality"] for r in rows], np.float64))


def _scored(batches: Iterator[pa.RecordBatch], shared, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    vectors, net = shared.value
    pool = Pooler(vectors)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        x = np.array([pool(t) for t in texts], np.float64).reshape(len(texts), 2 * DIMENSIONS)
        kept = batch.columns[1:]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(probability(x, net), pa.float64())], schema=schema)


def score(docs: DataFrame, model, columns: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns with the score under ``name``. Only the text decides."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    named = [F.col(f"`{c}`") for c in columns]
    schema = to_arrow_schema(docs.select(*named).schema).append(pa.field(name, pa.float64()))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*named).schema) + f"`{name}` double"
    return docs.select(F.col(f"`{text}`").alias(fresh(columns, "_text")), *named).mapInArrow(lambda it: _scored(it, shared, schema), kinds)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    scored = score(docs, fit(docs, labels), ["doc_id"])
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted as good."""
    name = fresh(docs.columns, "_score")
    scored = score(docs, fit(docs, labels), docs.columns, name=name)
    return scored.where(F.col(name) >= CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
