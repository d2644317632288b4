"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring both run over Arrow batches in numpy. A character is lower-cased and
everything that is no letter becomes a blank; the 1-, 2- and 3-grams of the result are hashed
into ``2 ** bits`` buckets. Counts are added up per partition before they are shuffled, the
log-probability matrix (buckets x languages, checked against ``max_languages``) is broadcast,
and a text's score is the sum of the rows its n-grams pick. Texts of any length are taken in
runs of ``RUN`` characters, so memory does not follow their length.

Defined cases: null text and text without a letter give ``und`` with score 0; a null id counts
as learnable and is not held out; without a single labelled row every text is ``und``; equal
scores go to the language that sorts first; repeated rows are scored one by one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from verdance.llm.common import remainder, small_batches

BITS = 15
ORDERS = (1, 2, 3)
RUN = 1 << 19
SMOOTHING = 0.5
MAX_LANGUAGES = 512
UNKNOWN = "und"
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@functools.cache
def _folded() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low[0])
    return out


def _codes(text: str) -> np.ndarray:
    raw = text.encode("utf-32-le", "surrogatepass")
    return _folded()[np.frombuffer(raw, "<u4")]


def _buckets(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    n = len(codes) - order + 1
    h = np.full(max(n, 0), order, np.uint32)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * _MIX[k % 3]
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def _runs(texts: list[str | None], run: int = RUN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, row of each, places where n-grams of the row start), about ``run`` at a
    time. A blank stands before each text and two after it; a longer text comes in parts, each
    with the two characters that follow it, so the n-grams do not depend on the cut."""
    codes, rows, starts, held = [], [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        text = " " + text
        for at in range(0, len(text), run):
            own = min(run, len(text) - at)
            part = np.full(own + 2, 32, np.uint32)
            seen = _codes(text[at : at + own + 2])
            part[: len(seen)] = seen
            codes.append(part)
            rows.append(np.full(own, i, np.int32))
            starts.append(np.arange(held, held + own))
            held += own + 2
            if held >= run:
                yield np.concatenate(codes), np.concatenate(rows), np.concatenate(starts)
                codes, rows, starts, held = [], [], [], 0
    if held:
        yield np.concatenate(codes), np.concatenate(rows), np.concatenate(starts)


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for codes, rows, starts in _runs(texts):
            names = sorted({langs[i] for i in np.unique(rows)})
            place = {x: k for k, x in enumerate(names)}
            kind = np.array([place.get(x, 0) for x in langs], np.int64)[rows]
            for order in ORDERS:
                b = _buckets(codes, order, bits)[starts]
                flat = np.bincount((kind << bits) + b, minlength=len(names) << bits)
                for k, x in enumerate(names):
                    part = flat[k << bits : (k + 1) << bits]
                    sums[x] = sums[x] + part if x in sums else part
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"lang": [lang] * len(at), "bucket": at.astype(np.int32), "n": counts[at].astype(np.int64)},
            schema=pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())]),
        )


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", bits: int = BITS, max_languages: int = MAX_LANGUAGES):
    """(languages, log-probability matrix, log priors) from all rows with text and language.

    What comes to the driver has at most ``max_languages * 2 ** bits`` numbers."""
    small_batches(rows.sparkSession)
    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    names = known.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    counted = (
        known.mapInArrow(lambda it: _count(it, bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
        .collect()
    )
    langs = [r["lang"] for r in names]
    counts = np.zeros((1 << bits, len(langs)))
    for r in counted:
        cells = np.array([(c["bucket"], c["n"]) for c in r["cells"]], np.int64).reshape(-1, 2)
        counts[cells[:, 0], langs.index(r["lang"])] = cells[:, 1]
    counts += SMOOTHING
    logs = np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32) if langs else counts
    total = sum(r["count"] for r in names)
    priors = np.log([r["count"] / total for r in names]) if langs else np.zeros(0)
    return langs, logs, priors


def _score(batches: Iterator[pa.RecordBatch], model, bits: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    langs, logs, priors = model.value
    for batch in batches:
        texts = batch.column("text").to_pylist()
        lettered = np.array(batch.column("lettered").to_pylist(), bool)
        sums = np.zeros((len(texts), len(langs))) + priors
        if langs:
            run = max(1 << 12, RUN * 8 // max(8, len(langs)))
            for codes, rows, starts in _runs([t if ok else None for t, ok in zip(texts, lettered, strict=True)], run):
                part = np.zeros((len(starts), len(langs)), np.float32)
                for order in ORDERS:
                    part += logs[_buckets(codes, order, bits)[starts]]
                first = np.flatnonzero(np.diff(rows, prepend=-1))
                np.add.at(sums, rows[first], np.add.reduceat(part, first, axis=0, dtype=np.float64))
            best = sums.argmax(axis=1)
            score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        out = {c: batch.column(c) for c in schema.names if c in batch.schema.names}
        known = lettered & bool(langs)
        out["lang_pred"] = [langs[best[i]] if known[i] else UNKNOWN for i in range(len(texts))]
        out["score"] = [float(score[i]) if known[i] else 0.0 for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if isinstance(out[f.name], list) else out[f.name] for f in schema], schema=schema)


def predict(docs: DataFrame, model, bits: int = BITS, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns with ``lang_pred`` and ``score``. Only the text decides."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)
    src = docs.select(
        *keys, F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.select(*keys).schema)
    schema = to_arrow_schema(src.select(*keys).schema)
    for f in (pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())):
        schema = schema.append(f)
    return src.mapInArrow(lambda it: _score(it, held, bits, schema), f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and predicts every row."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit(docs.where(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
