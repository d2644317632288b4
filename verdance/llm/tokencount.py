"""Token counts: pieces are counted once per distinct pre-token and summed over the
pre-token frequencies of each document; no list of ids is made.

A pre-token is a run of blanks and line ends with what follows up to the next one. No piece of
the model holds a blank after another character, nor a line end (checked when it is loaded), so
no merge crosses a pre-token's border and the sum is what the library gives for the whole text.

1. A bounded sample gives the commonest pre-tokens (``hot``, at most HOT_MOST of at most
   HOT_BYTES each); their counts are broadcast. The sample only decides which way a pre-token
   takes, never a result.
2. One pass turns each text into pre-token frequencies. Common ones are looked up on the spot.
   The others leave as one row per distinct pre-token of a run of documents, with a packed list
   of (row, frequency).
3. All rows of a pre-token meet in one partition, where its pieces are counted once, multiplied
   and added up per document. The sums of a run of documents leave as one packed row, and are
   added to the run's documents after the last shuffle. A pre-token that many documents share and
   that the sample missed is salted by its run, so its lists are never gathered in one place.

Defined cases: null text counts as empty (0 bytes, 0 tokens); equal ids, null ids and repeated
rows are kept apart and counted one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from verdance.llm.common import row_id, small_batches

MODEL = "piece_bpe_32k.model"
#: A text with more tokens than this is over the limit.
LIMIT = 4096
HOT_ROWS, HOT_CHARS, HOT_MOST, HOT_BYTES = 1000, 20_000, 32768, 48
#: Postings and pre-token characters held before a run's rows leave.
RUN_POSTINGS, RUN_CHARS = 2_000_000, 4_000_000
#: Postings of one row; a longer list is common enough to be salted.
SALTED, SALTS = 512, 64
#: Characters of pre-tokens whose counts a task remembers; their rows come in no order.
MEMO = 6_000_000

_irregular = re.compile(r"[ \n]+[^ \n]*")


@functools.cache
def _library(path: str) -> sentencepiece.SentencePieceProcessor:
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i):
            continue
        piece = sp.id_to_piece(i)
        if "\n" in piece or re.search("[^▁]▁", piece):
            raise ValueError(f"a piece of {path} crosses the border of pre-tokens: {piece!r}")
    if sp.encode("a  b ") != sp.encode("a") + sp.encode("▁b") + [sp.piece_to_id("▁")]:
        raise ValueError(f"{path} does not keep blanks as they are")
    return sp


def frequencies(text: str) -> Counter:
    """Pre-tokens of a text with their counts. A key is a word that a single blank precedes,
    or a word with the line end or the several blanks before it."""
    if not text:
        return Counter()
    text = text.replace("▁", " ")
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n":
        found = _irregular.findall(" " + text)
        return Counter([x[1:] if x[0] == " " and x[1:2] not in (" ", "\n", "") else x for x in found])
    first, *lines = text.split("\n")
    words = first.split(" ")
    for line in lines:
        rest = line.split(" ")
        rest[0] = "\n" + rest[0]
        words += rest
    return Counter(words)


def pieces(sp: sentencepiece.SentencePieceProcessor, keys: list[str]) -> list[int]:
    """Tokens of each pre-token as it stands inside a text."""
    plain = [x[1:] if x[0] == " " else x for x in keys]  # the library puts a blank before
    counts = [len(x) for x in sp.encode(plain, num_threads=1)]
    return [
        1 if x == " " else n - 1 if x[0] == "\n" else n for x, n in zip(keys, counts, strict=True)
    ]


def common_pieces(docs: DataFrame, text: str, path: str) -> dict[str, int]:
    """Counts of the commonest pre-tokens of a sample: at most HOT_MOST entries of HOT_BYTES.
    At most HOT_ROWS times HOT_CHARS characters come to the driver, from as few partitions as
    hold them."""
    seen: Counter = Counter()
    for r in docs.select(F.substring(F.col(text), 1, HOT_CHARS).alias("text")).limit(HOT_ROWS).collect():
        seen.update(frequencies(r["text"] or ""))
    ranked = sorted(((n, x) for x, n in seen.items() if n > 1 and len(x.encode()) <= HOT_BYTES), key=lambda r: (-r[0], r[1]))
    keys = [x for _, x in ranked[:HOT_MOST]]
    return dict(zip(keys, pieces(_library(path), keys), strict=True)) if keys else {}


def _rows(key: pa.DataType, *first: tuple[str, pa.DataType]) -> pa.Schema:
    """Rows of pre-tokens (base, packed postings or sums) and of documents (base, rid, ...)."""
    rest = [("base", pa.int64()), ("post", pa.binary()), ("rid", pa.int64()), ("key", key), ("n_bytes", pa.int64()), ("tokens", pa.int64())]
    return pa.schema([*first, *rest])


def _packed(pairs: list[int] | np.ndarray) -> bytes:
    if max(pairs) > 0xFFFF:
        return b"\4" + np.array(pairs, "<u4").tobytes()
    return b"\2" + np.array(pairs, "<u2").tobytes()


def _spread(batches: Iterator[pa.RecordBatch], hot, salted: int, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A row for each document (base of its run, rid, key, bytes, tokens of its common
    pre-tokens) and one for each other pre-token of a run (base, packed pairs of row number
    less base and frequency). A run is a stretch of documents, named by its first row."""
    known, schema = hot.value, _rows(key, ("piece", pa.string()), ("salt", pa.int32()))
    found: dict[str, list[int]] = {}
    base, held, chars, runs = -1, 0, 0, 0

    def leave() -> Iterator[pa.RecordBatch]:
        keys = list(found)
        salt = 1 + (runs + zlib.crc32(str(base).encode())) % SALTS
        for at in range(0, len(keys), 20_000):
            part = keys[at : at + 20_000]
            nulls = [None] * len(part)
            salts = [salt if len(found[x]) >= 2 * salted else 0 for x in part]
            columns = (part, salts, [base] * len(part), [_packed(found[x]) for x in part], nulls, nulls, nulls, nulls)
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)

    for batch in batches:
        rids, sums, sizes, bases = batch.column(0).to_pylist(), [], [], []
        for rid, text in zip(rids, batch.column(2).to_pylist(), strict=True):
            total = 0
            if base < 0:
                base = rid
            bases.append(base)
            for x, n in frequencies(text).items():
                c = known.get(x)
                if c is not None:
                    total += c * n
                    continue
                at = found.get(x)
                if at is None:
                    found[x] = [rid - base, n]
                    chars += len(x)
                else:
                    at += (rid - base, n)
                held += 1
            sums.append(total)
            sizes.append(len(text.encode()))
            if held >= RUN_POSTINGS or chars >= RUN_CHARS:
                yield from leave()
                found, base, held, chars, runs = {}, -1, 0, 0, runs + 1
        nulls = [None] * len(rids)
        columns = (nulls, [0] * len(rids), bases, nulls, rids, batch.column(1), sizes, sums)
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)
    if found:
        yield from leave()


def _unpacked(post: bytes) -> np.ndarray:
    return np.frombuffer(post, "<u2" if post[0] == 2 else "<u4", offset=1).astype(np.int64).reshape(-1, 2)


def _join(batches: Iterator[pa.RecordBatch], path: str, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Counts each pre-token when its first row comes, and adds up by document. What it has
    of a run leaves as one row of packed (row number less base, tokens) pairs. The rows of the
    documents themselves pass."""
    sp, schema = _library(path), _rows(key)
    memo: dict[str, int] = {}
    held: dict[int, list[np.ndarray]] = {}
    total = chars = 0

    def leave() -> pa.RecordBatch:
        posts = []
        for parts in held.values():
            pairs = np.concatenate(parts)
            offsets, at = np.unique(pairs[:, 0], return_inverse=True)
            sums = np.bincount(at, weights=pairs[:, 1]).astype(np.int64)
            posts.append(_packed(np.stack([offsets, sums], axis=1).reshape(-1)))
        nulls = [None] * len(posts)
        return pa.RecordBatch.from_pydict(dict(zip(schema.names, (list(held), posts, nulls, nulls, nulls, nulls), strict=True)), schema=schema)

    for batch in batches:
        own = batch.column("piece").is_null()
        yield batch.filter(own).select(schema.names)
        batch = batch.filter(pa.compute.invert(own))
        keys = batch.column("piece").to_pylist()
        if chars > MEMO:
            memo, chars = {}, 0
        new = [x for x in dict.fromkeys(keys) if x not in memo]
        if new:
            memo.update(zip(new, pieces(sp, new), strict=True))
            chars += sum(map(len, new))
        single: dict[int, list[int]] = {}
        for x, base, post in zip(keys, batch.column("base").to_pylist(), batch.column("post").to_pylist(), strict=True):
            if len(post) == 5:
                one = single.setdefault(base, [])
                one.append(post[1] + (post[2] << 8))
                one.append(memo[x] * (post[3] + (post[4] << 8)))
                total += 1
            else:
                pairs = _unpacked(post)
                pairs[:, 1] *= memo[x]
                held.setdefault(base, []).append(pairs)
                total += len(pairs)
        for base, one in single.items():
            held.setdefault(base, []).append(np.array(one, np.int64).reshape(-1, 2))
        if total >= 2_000_000:
            yield leave()
            held, total = {}, 0
    if held:
        yield leave()


def _total(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds the sums of a run to its documents; rows come run by run."""
    base = None
    rows: list[tuple] = []
    parts: list[np.ndarray] = []

    def leave() -> pa.RecordBatch:
        pairs = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
        last = max((r[0] for r in rows), default=base) - base
        sums = np.bincount(pairs[:, 0], weights=pairs[:, 1], minlength=last + 1).astype(np.int64)
        columns = ([r[1] for r in rows], [r[2] for r in rows], [r[3] + int(sums[r[0] - base]) for r in rows])
        return pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("base", "post", "rid", "key", "n_bytes", "tokens")]
        for b, post, *row in zip(*columns, strict=True):
            if b != base:
                if rows:
                    yield leave()
                base, rows, parts = b, [], []
            if post is None:
                rows.append(tuple(row))
            else:
                parts.append(_unpacked(post))
    if rows:
        yield leave()


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    model: str | None = None,
    limit: int = LIMIT,
    salted: int = SALTED,
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    path = model or public_tokenizers.path(MODEL)
    hot = spark.sparkContext.broadcast(common_pieces(docs, text, path))
    rows = docs.select(row_id().alias("rid"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType
    arrow = to_arrow_type(kind)
    rest = f"base long, post binary, rid long, key {kind.simpleString()}, n_bytes long, tokens long"
    spread = rows.mapInArrow(lambda it: _spread(it, hot, salted, arrow), f"piece string, salt int, {rest}")
    met = spread.repartition(F.coalesce("piece", F.col("rid").cast("string")), "salt")
    sums = met.mapInArrow(lambda it: _join(it, path, arrow), rest)
    runs = sums.repartition("base").sortWithinPartitions("base")
    schema = pa.schema([("key", arrow), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    done = runs.mapInArrow(lambda it: _total(it, schema), f"key {kind.simpleString()}, n_bytes long, n_tokens long")
    return done.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
