"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary (hash, displace; slots = tokens) finds a
whole pre-token that is a token with one hash and one comparison. Tier two: other pre-tokens
are merged with a heap over linked bytes, n log n however long the pre-token is. What a task has
met it remembers, up to a bounded number of entries. Vocabulary and hash are broadcast; their
size is that of the rank file.

A text is first cut before single blanks: there the pattern always starts a new pre-token, so
the parts can be remembered too. Texts with other runs of blanks are matched as a whole.

Defined cases: null text counts as empty (no ids, digests of no bytes); special tokens have no
meaning in texts; equal ids, null ids and repeated rows are encoded one by one; an empty table
gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from verdance.llm.common import small_batches

RANKS = "byte_bpe_50k.tiktoken"
#: Entries that a task remembers of each kind, and the longest that it remembers.
MEMO, MEMO_CHARS = 200_000, 64
#: Displaced hashes are taken modulo a prime far above any vocabulary, so each reaches all slots.
PRIME = (1 << 31) - 1
#: Unicode white space, as the pattern's library takes \s.
SPACES = "\t-\r \x85\xa0  -     　"


def spelled_out(pattern: str) -> str:
    """The pattern with \\s and \\S written as the fixed class."""
    inside = pattern.replace(r"[^\s", f"[^{SPACES}")
    return inside.replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _hash(key: bytes) -> tuple[int, int, int]:
    d = int.from_bytes(hashlib.blake2b(key, digest_size=15).digest(), "little")
    return d & 0xFFFFFFFFFF, (d >> 40) & 0xFFFFFFFFFF, d >> 80


class PerfectHash:
    """Minimal perfect hash of byte strings: as many slots as keys, two reads per lookup."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n // 4)
        self.shift = [0] * self.buckets
        held: dict[int, list[int]] = {}
        hashes = [_hash(k) for k in keys]
        for i, (a, _, _) in enumerate(hashes):
            held.setdefault(a % self.buckets, []).append(i)
        free, slot_of = np.ones(n, bool), [0] * n
        singles = []
        for bucket, members in sorted(held.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((bucket, members[0]))
                continue
            b = np.array([hashes[i][1] for i in members]) % PRIME
            c = np.array([hashes[i][2] for i in members]) % (PRIME - 1) + 1
            at = 0
            while True:
                slots = (b + np.arange(at, at + 256)[:, None] * c) % PRIME % n
                ordered = np.sort(slots, axis=1)
                good = free[slots].all(axis=1) & (np.diff(ordered, axis=1) > 0).all(axis=1)
                if good.any():
                    break
                at += 256
            pick = int(good.argmax())
            self.shift[bucket] = at + pick
            for i, s in zip(members, slots[pick].tolist(), strict=True):
                free[s], slot_of[i] = False, s
        for (bucket, i), s in zip(singles, np.flatnonzero(free).tolist(), strict=False):
            self.shift[bucket] = -s - 1  # a lone key takes a free slot as it is
            slot_of[i] = s
        self.ids = [0] * n
        for i, s in enumerate(slot_of):
            self.ids[s] = i

    def find(self, key: bytes) -> int:
        """The only id that the key can have."""
        a, b, c = _hash(key)
        shift = self.shift[a % self.buckets]
        if shift < 0:
            return self.ids[-shift - 1]
        return self.ids[(b % PRIME + shift * (c % (PRIME - 1) + 1)) % PRIME % self.size]


@functools.cache
def vocabulary(path: str) -> tuple[list[bytes], PerfectHash]:
    tokens = read_ranks(path)
    return tokens, PerfectHash(tokens)


class Encoder:
    def __init__(self, tokens: list[bytes], table: PerfectHash, pattern: str):
        self.tokens, self.table = tokens, table
        self.single = [0] * 256
        for i, t in enumerate(tokens):
            if len(t) == 1:
                self.single[t[0]] = i
        self.match = regex.compile(spelled_out(pattern)).findall
        self.pairs: dict[int, int] = {}
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.past_words: dict[str, bytes] = {}
        self.past_parts: dict[str, bytes] = {}

    def rest(self) -> None:
        """Bounds the pairs remembered; between texts only, as a merge relies on them."""
        if len(self.pairs) > 4 * MEMO:
            self.pairs.clear()

    def _joined(self, left: int, right: int) -> int:
        """Rank of two tokens put together, or -1."""
        key = left << 32 | right
        rank = self.pairs.get(key)
        if rank is None:
            whole = self.tokens[left] + self.tokens[right]
            rank = self.table.find(whole)
            if self.tokens[rank] != whole:
                rank = -1
            self.pairs[key] = rank
        return rank

    def merged(self, word: bytes) -> list[int]:
        """Always merges the pair with the lowest rank, the first of equal ones."""
        single, known, joined = self.single, self.pairs.get, self._joined
        ids = [single[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []  # rank * n + place
        for i in range(n - 1):
            r = known(ids[i] << 32 | ids[i + 1])
            if r is None:
                r = joined(ids[i], ids[i + 1])
            if r >= 0:
                heap.append(r * n + i)
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rank, i = divmod(pop(heap), n)
            j = after[i]
            if j >= n or ids[i] < 0 or (known(ids[i] << 32 | ids[j]) if ids[j] >= 0 else -1) != rank:
                continue  # one side has been merged since
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = known(rank << 32 | ids[k])
                if r is None:
                    r = joined(rank, ids[k])
                if r >= 0:
                    push(heap, r * n + i)
            k = before[i]
            if k >= 0:
                r = known(ids[k] << 32 | rank)
                if r is None:
                    r = joined(ids[k], rank)
                if r >= 0:
                    push(heap, r * n + k)
        return [x for x in ids if x >= 0]

    def word(self, text: str) -> bytes:
        """Ids of a pre-token, four bytes each (the machine's order, little-endian as Spark's)."""
        got = self.words.get(text)
        if got is None:
            got = self.past_words.get(text)
            if got is None:
                raw = text.encode()
                i = self.table.find(raw)
                got = array("I", [i] if self.tokens[i] == raw else self.merged(raw)).tobytes()
            if len(text) <= MEMO_CHARS:
                if len(self.words) >= MEMO:
                    self.past_words, self.words = self.words, {}
                self.words[text] = got
        return got

    def part(self, text: str) -> bytes:
        """Ids of a part that starts with a blank, given without it."""
        got = self.past_parts.get(text)
        if got is None:
            found = self.match(" " + text)
            got = self.word(found[0]) if len(found) == 1 else b"".join(map(self.word, found))
        if len(text) <= MEMO_CHARS:
            if len(self.parts) >= MEMO:
                self.past_parts, self.parts = self.parts, {}
            self.parts[text] = got
        return got

    def __call__(self, text: str) -> bytes:
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return b"".join(map(self.word, self.match(text)))
        first, *rest = text.split(" ")
        out = [b"".join(map(self.word, self.match(first)))]
        for x in rest:
            got = self.parts.get(x)
            out.append(self.part(x) if got is None else got)
        return b"".join(out)


#: A worker's encoder by pattern: what it remembers serves its later tasks too.
_encoders: dict[str, Encoder] = {}


def _encoded(batches: Iterator[pa.RecordBatch], shared, pattern: str, schema: pa.Schema, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tokens, table = shared.value
    encode = _encoders.get(pattern)
    if encode is None or encode.tokens != tokens:
        encode = _encoders[pattern] = Encoder(tokens, table, pattern)
    for batch in batches:
        n, ids_sha, decoded_sha, offsets, packed = [], [], [], [0], []
        for text in batch.column("_text").to_pylist():
            encode.rest()
            raw = encode(text or "")
            n.append(len(raw) // 4)
            ids_sha.append(hashlib.sha256(raw).hexdigest())
            decoded_sha.append(hashlib.sha256(decoded(raw, tokens)).hexdigest())
            if with_ids:
                packed.append(raw)
                offsets.append(offsets[-1] + len(raw) // 4)
        out = [batch.column(name) for name in schema.names if name in batch.schema.names]
        out += [pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
        if with_ids:
            values = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
            out.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
        yield pa.RecordBatch.from_arrays(out, schema=schema)


def decoded(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes of packed ids."""
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """The key columns with n_tokens, ids_sha256, decoded_sha256 and, if asked for, ``ids``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(path or public_tokenizers.path(RANKS)))
    pattern = public_tokenizers.PATTERN
    kept = docs.select(*[F.col(f"`{k}`") for k in keys])
    schema = to_arrow_schema(kept.schema)
    for name, kind in (("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())):
        schema = schema.append(pa.field(name, kind))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema) + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema, kinds = schema.append(pa.field("ids", pa.list_(pa.int32()))), kinds + ", ids array<int>"
    src = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("_text"))
    return src.mapInArrow(lambda it: _encoded(it, shared, pattern, schema, with_ids), kinds)


def _read_back(batches: Iterator[pa.RecordBatch], shared, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    tokens = shared.value
    for batch in batches:
        texts = [b"".join([tokens[i] for i in x or ()]).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in schema.names[:-1]], pa.array(texts, pa.string())], schema=schema)


def decode(encoded: DataFrame, keys: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """The key columns with the text of ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path or public_tokenizers.path(RANKS)))
    kept = encoded.select(*keys)
    schema = to_arrow_schema(kept.schema).append(pa.field("text", pa.string()))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema) + "text string"
    return encoded.select(*keys, "ids").mapInArrow(lambda it: _read_back(it, shared, schema), kinds)
