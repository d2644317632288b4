"""Near-duplicates by HyperMinHash.

A text's set is that of its distinct word shingles. Under each of REGISTERS hash functions the
smallest value of the set is kept as a register: the number of its leading zeros and MANTISSA
bits that follow. BANDS groups of ROWS registers are bucket keys. Two texts that share a bucket
are compared by their registers, where the share of equal ones is corrected for those that
agree by accident; a pair that may reach the threshold is then settled on the full sets.

No bucket is turned into all its pairs:

- texts with the same set form one class from the start, only its first row goes on;
- each class is first compared with a single other one: of the centers of its buckets the one
  that looks most alike. A bucket's center is its member that shares most buckets with others:
  of the copies of a text that is the text itself, which is nearer to each of them than they
  are to each other, so a large group is tied together in one step;
- after that only buckets are looked at that hold several components. Of the members of those the
  sets are read once. Within groups of members that buckets tie together, each set is sorted by how
  many members have a shingle, rarest first. Two sets that reach the threshold share one of their
  first shingles (a fifth of each), and the first one they share bounds what they share at all. So
  these shingles take the place of the bands: copies of a text that each changed other words
  have changed ones in front, which few others have, and texts that only share a passage meet
  nowhere. A pair that cannot reach the threshold from there never leaves the join that would
  make it;
- each member is compared with one member of each other component. Where two components have
  several members at a shingle, this repeats with other members until a round finds no link any
  more, then with about FEW members of each component, and at last with all: the rounds end when
  every pair of members of different components that may reach the threshold has been compared.
  Elsewhere all has been compared at once;
- who looks alike is also told from 128 bits, one per register, that travel with the bucket keys:
  of two texts at the threshold 13 differ, and 31 or more in one of two million cases.

With 32 bands of 5 a pair at 0.8 shares no band in 3 of a million cases; below 0.8 nothing is
linked, because links are confirmed on the sets.

Defined cases: null text, empty text and text of blanks have an empty set (n_shingles 0), are
linked with nothing and stay, each on its own; a text with fewer words than a shingle has its
whole sequence as only member; equal ids, null ids and repeated rows are separate rows (a null
id counts as larger than any other); an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from verdance.llm.common import forget, row_id, small_batches, stored
from verdance.llm.graph import components

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: How far below the threshold an estimate may lie: five standard deviations at 0.8.
MARGIN = 0.16
#: Members of a component that are compared in the rounds before the last.
FEW = 16
#: Members of a bucket that meet the others in one piece of work.
BLOCK = 4096
#: Row numbers that may be broadcast to pick texts by (two longs each); more are shuffled.
PICKED_MOST = 1_000_000
#: Registers that give a bit each, and the bits that may differ: mean and five deviations at 0.8.
BITS, DIFFERING = 128, 30
#: Words whose hashes a task remembers.
MEMO = 300_000

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, REGISTERS, np.uint64).astype(np.uint32)
_C = _rng.integers(0, 1 << 62, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of 64-bit shingle hashes; remembers a bounded number of word hashes."""

    def __init__(self, size: int):
        self.size, self.memo = size, {}

    def _word(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self.memo) >= MEMO:
            self.memo.clear()
        if len(word) <= 64:
            self.memo[word] = h
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes. ASCII letters are lower-cased, ASCII blanks part words."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        get = self.memo.get
        w = np.array([get(x) or self._word(x) for x in words], np.uint64)
        k = min(self.size, len(w))
        n = len(w) - k + 1
        acc = np.full(n, k, np.uint64)
        for i in range(k):
            acc = _mixed(acc + w[i : i + n])
        return np.unique(acc)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of the smallest value under each hash function."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    v = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(v), 2048):
        low = np.minimum(low, (v[at : at + 2048, None] * _A + _B).min(axis=0))
    bits = low.astype(np.float64).view(np.uint64)
    zeros = np.where(low == 0, 32, 1054 - (bits >> np.uint64(52)).astype(np.int64))
    mantissa = (bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def bands(signatures: np.ndarray) -> np.ndarray:
    """Bucket keys (rows x BANDS); the band's number is part of the key."""
    regs = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    acc = np.zeros(regs.shape[:2], np.uint64)
    for r in range(ROWS):
        acc = _mixed(acc + regs[:, :, r] * _C[:, r])
    return acc.view(np.int64)


def bits(signature: np.ndarray) -> tuple[int, int]:
    """One bit of each of the first BITS registers, as two longs."""
    mixed = _mixed(signature[:BITS].astype(np.uint64) + _C.reshape(-1)[:BITS])
    return tuple(np.packbits((mixed & np.uint64(1)).astype(np.uint8)).view(np.int64).tolist())


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}1").bitwiseXOR(F.col(f"{b}1"))) + F.bit_count(F.col(f"{a}2").bitwiseXOR(F.col(f"{b}2")))


def accidental(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Chance that a register agrees although the smallest values differ, for two set sizes.
    Within the values with l leading zeros a cell is 2 ** -(l + 1 + MANTISSA) wide."""
    rate, total = n1 * n2 / (n1 + n2), n1 + n2
    out = np.zeros(len(n1))
    for zeros in range(32):
        inside = np.exp(-total * 2.0 ** -(zeros + 1)) - np.exp(-total * 2.0**-zeros)
        out += 2.0 ** -(zeros + 1 + MANTISSA) * rate * inside
    return out


def estimate(s1: np.ndarray, s2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers (rows x REGISTERS), corrected for accidents."""
    same = (s1 == s2).mean(axis=1)
    c = accidental(n1.astype(float), n2.astype(float))
    return (same - c) / (1 - c)


def _sign(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    sets = Shingles(size)
    for batch in batches:
        n, digests, signatures, first, second = [], [], [], [], []
        for text in batch.column("_text").to_pylist():
            s = sets(text)
            n.append(len(s))
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            signature = registers(s) if len(s) else None
            signatures.append(None if signature is None else signature.tobytes())
            one, two = (None, None) if signature is None else bits(signature)
            first.append(one)
            second.append(two)
        made = [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
        made += [pa.array(first, pa.int64()), pa.array(second, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema=schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = bands(np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("rid").to_numpy(), BANDS)), pa.array(keys.reshape(-1))], names=["rid", "key"]
            )


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            s1, s2 = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            j = estimate(s1, s2, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            yield batch.filter(pa.array(j >= least)).select(["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    sets = Shingles(size)
    for batch in batches:
        found = [sets(x).view(np.int64) for x in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(found, pa.list_(pa.int64()))], names=["rid", "hashes"])


def _marked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Each shingle of each text, mixed with the text's group, and the text."""
    sets = Shingles(size)
    for batch in batches:
        for text, rid, group in zip(*[batch.column(c).to_pylist() for c in ("_text", "rid", "g")], strict=True):
            h = sets(text)
            seed = _mixed(np.array([group], np.int64).view(np.uint64))
            for at in range(0, len(h), 65_536):
                part = _mixed(h[at : at + 65_536] ^ seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), rid, np.int64))], names=["h", "rid"])


class NearCopies:
    """One run over ``docs``. ``rows`` are the stored rows with _rid, _n and _digest."""

    def __init__(self, docs: DataFrame, size: int, threshold: int, text: str = "text", columns: list[str] | None = None):
        self.size, self.threshold = size, threshold
        small_batches(docs.sparkSession)
        named = [F.col(f"`{c}`").alias(f"c_{c}") for c in (columns if columns is not None else docs.columns)]
        src = docs.select(row_id().alias("_rid"), F.col(f"`{text}`").alias("_text"), *named)
        arrow = to_arrow_schema(src.schema)
        for name, kind in (("_n", pa.int64()), ("_digest", pa.binary()), ("_sig", pa.binary()), ("_b1", pa.int64()), ("_b2", pa.int64())):
            arrow = arrow.append(pa.field(name, kind))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema)
        self.rows = stored(src.mapInArrow(lambda it: _sign(it, size, arrow), f"{kinds}, _n long, _digest binary, _sig binary, _b1 long, _b2 long"), "signed")

    def classes(self) -> DataFrame:
        """(digest, rid): the first row of each set."""
        return self.rows.where("_n > 0").groupBy("_digest").agg(F.min("_rid").alias("rid"))

    def _verify(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold. Stored."""
        size, threshold = self.size, self.threshold
        first = nodes.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
        second = nodes.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
        sized = pairs.join(first, "a").join(second, "b").where(
            (100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
        )
        least = threshold / 100 - MARGIN
        likely = stored(
            sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(lambda it: _likely(it, least), "a long, b long"), "likely"
        )
        wanted = stored(likely.select(F.explode(F.array("a", "b")).alias("_rid")).distinct(), "wanted")
        texts = self._picked(wanted).select(F.col("_rid").alias("rid"), "_text")
        sets = stored(texts.mapInArrow(lambda it: _sets(it, size), "rid long, hashes array<long>"), "sets")
        both = likely.join(sets.select(F.col("rid").alias("a"), F.col("hashes").alias("ha")), "a").join(
            sets.select(F.col("rid").alias("b"), F.col("hashes").alias("hb")), "b"
        )
        shared = F.size(F.array_intersect("ha", "hb"))
        found = stored(
            both.select("a", "b", shared.alias("i"), (F.size("ha") + F.size("hb") - shared).alias("u"))
            .where(100 * F.col("i") >= threshold * F.col("u"))
            .select("a", "b"),
            "links",
        )
        forget(likely, sets, wanted)
        return found

    def _picked(self, wanted: DataFrame) -> DataFrame:
        """The texts of stored row numbers, with what columns these have. The texts stay where they
        are as long as the numbers are few enough to be sent to them."""
        side = F.broadcast(wanted) if wanted.count() <= PICKED_MOST else wanted
        return self.rows.select("_rid", "_text").join(side, "_rid")

    def components(self) -> DataFrame:
        """(node, comp) of the classes that have links; nodes are row numbers. Stored."""
        first = self.classes()
        nodes = stored(
            self.rows.where("_n > 0")
            .select(F.col("_rid").alias("rid"), F.col("_n").alias("n"), F.col("_sig").alias("sig"), F.col("_b1").alias("x1"), F.col("_b2").alias("x2"))
            .join(first.select("rid"), "rid", "left_semi"),
            "nodes",
        )
        keyed = nodes.select("rid", "sig").mapInArrow(_keys, "rid long, key long")
        shared = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
        met = stored(keyed.join(shared, "key"), "met")
        weights = met.groupBy("rid").agg(F.sum("n").alias("weight")).join(nodes.select("rid", F.col("n").alias("words"), "x1", "x2"), "rid")
        weights = stored(weights, "weights")
        members = stored(met.drop("n").join(weights, "rid"), "members")
        forget(shared, met, weights)
        first = members.groupBy("key").agg(F.max(F.struct("weight", "rid", "x1", "x2")).alias("c"))
        centers = stored(first.select("key", F.col("c.rid").alias("center"), F.col("c.x1").alias("y1"), F.col("c.x2").alias("y2")), "centers")
        faced = members.join(centers, "key").where(F.col("rid") != F.col("center"))
        nearest = faced.withColumn("d", _differing("x", "y")).where(F.col("d") <= DIFFERING)
        # distance first, then the smaller row number
        pairs = nearest.groupBy("rid").agg(F.min_by("center", F.col("d") + F.col("center") / 2.0**63).alias("b"))
        pairs = stored(pairs.select(F.col("rid").alias("a"), "b"), "pairs")
        forget(centers)
        links = self._verify(pairs, nodes)
        tested, labels, turn, most = [pairs], components(links), 0, 1
        forget(links)
        held = self._open(members, labels)
        forget(members)
        if held.isEmpty():
            forget(nodes, held, pairs)
            return labels
        first = self._prefixes(held)
        opened = self._open(first, labels)
        forget(held, first)
        held = opened
        while True:
            spent: list[DataFrame] = []
            able = self._able(held)
            pairs = self._across(able, turn, spent) if most == 1 else self._further(able, turn, most, spent)
            for past in tested:
                pairs = pairs.join(past, ["a", "b"], "left_anti")
            pairs = stored(pairs, "pairs")
            forget(able, *spent)
            tested.append(pairs)
            links = None if pairs.isEmpty() else self._verify(pairs, nodes)
            if links is not None and not links.isEmpty():
                before = labels
                labels = components(before.toDF("a", "b").union(links))
                still = self._open(held, labels)
                forget(before, held)
                held = still
            elif most is None:
                break
            else:
                most = FEW if most == 1 else None
            if links is not None:
                forget(links)
            turn += 1
        forget(nodes, held, *tested, *([links] if links is not None else []))
        return labels

    def _open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """The members of buckets that hold several components, with these. A bucket that holds one
        never holds several again, so the next round goes on from here. Stored."""
        own = members.drop("comp").join(labels.select(F.col("node").alias("rid"), "comp"), "rid", "left")
        own = stored(own.withColumn("comp", F.coalesce("comp", "rid")), "own")
        sides = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
        held = stored(own.join(sides.select("key"), "key", "left_semi"), "held")
        forget(own)
        return held

    def _prefixes(self, held: DataFrame) -> DataFrame:
        """The members under their rarest shingles instead of their bands: (key, rid, comp, x1, x2,
        weight, words, c). A set of n goes under its first n - ceil(threshold n) + 1 shingles; c is
        how many of its shingles are not before that one. Stored."""
        size = self.size
        spans = held.select("key", "rid")
        low = spans.groupBy("key").agg(F.min("rid").alias("low"))
        groups = components(spans.join(low, "key").select("rid", "low"))
        wanted = stored(groups.select(F.col("node").alias("_rid"), F.col("comp").alias("g")), "wanted")
        texts = self._picked(wanted).select(F.col("_rid").alias("rid"), "_text", "g")
        marks = stored(texts.mapInArrow(lambda it: _marked(it, size), "h long, rid long"), "marks")
        often = marks.groupBy("h").agg(F.count("*").alias("often"))
        rarest = Window.partitionBy("rid").orderBy("often", "h")
        placed = marks.join(often, "h").withColumn("place", F.row_number().over(rarest))
        members = held.select("rid", "comp", "x1", "x2", "weight", "words").distinct()
        within = F.col("place") <= F.col("words") - F.ceil(F.col("words") * self.threshold / 100) + 1
        first = placed.join(members, "rid").where(within).withColumn("c", F.col("words") - F.col("place") + 1)
        done = stored(first.select(F.col("h").alias("key"), "rid", "comp", "x1", "x2", "weight", "words", "c"), "prefixes")
        forget(groups, wanted, marks)
        return done

    def _able(self, held: DataFrame) -> DataFrame:
        """The members that may reach the threshold with the smallest set of their bucket. Stored."""
        least = held.groupBy("key").agg(F.min("words").alias("least"))
        bound = (100 + self.threshold) * F.col("c") >= self.threshold * (F.col("words") + F.col("least"))
        return stored(held.join(least, "key").where(bound).drop("least"), "able")

    def _alike(self) -> Column:
        """Whether a pair may reach the threshold by the sizes of its sets, by what is left of each
        from the shingle on where they meet, and by its register bits."""
        sizes = 100 * F.least("words", "others") >= self.threshold * F.greatest("words", "others")
        most = (100 + self.threshold) * F.least("c", "d") >= self.threshold * (F.col("words") + F.col("others"))
        return sizes & most & (_differing("x", "y") <= DIFFERING)

    def _across(self, held: DataFrame, turn: int, spent: list[DataFrame]) -> DataFrame:
        """Pairs of a member and one member of another component of its bucket."""
        # what a row of ``held`` is compared with: one center for each other component
        turned = F.xxhash64("rid", F.lit(turn)) if turn else F.col("weight")
        one = F.max(F.struct(turned.alias("order"), "rid", "x1", "x2", "words", "c")).alias("one")  # as a whole, ties included
        centers = held.groupBy("key", "comp").agg(one, F.count("*").alias("size"))
        if turn:  # two components of one member each, or one and many, were compared whole
            several = centers.where("size > 1").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
            centers = centers.join(several, "key", "left_semi")
        chosen = [F.col(f"one.{c}").alias(n) for c, n in (("rid", "b"), ("x1", "y1"), ("x2", "y2"), ("words", "others"), ("c", "d"))]
        centers = stored(centers.select("key", F.col("comp").alias("other"), *chosen), "centers")
        spent.append(centers)
        pairs = held.join(centers, "key").where((F.col("comp") != F.col("other")) & self._alike())
        return pairs.select(F.greatest("rid", "b").alias("a"), F.least("rid", "b").alias("b")).distinct()

    def _further(self, held: DataFrame, turn: int, most: int | None, spent: list[DataFrame]) -> DataFrame:
        """Pairs of members of two components that have several in a bucket: about ``most`` of the
        smaller one (None: all) against all of the larger, whose members are dealt into blocks."""
        sizes = held.groupBy("key", "comp").agg(F.count("*").alias("size")).where("size > 1")
        several = sizes.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("total")).where("n > 1")
        several = several.select("key", F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"))
        sized = stored(held.join(sizes.join(several, "key"), ["key", "comp"]), "several")
        spent.append(sized)
        large = sized.withColumn("block", F.pmod(F.xxhash64("rid"), "blocks").cast("int"))
        few = sized if most is None else sized.where(F.pmod(F.xxhash64("rid", F.lit(turn)), F.ceil(F.col("size") / most)) == 0)
        small = few.select(
            "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("rid").alias("b"), F.col("comp").alias("other"),
            F.col("size").alias("less"), F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("words").alias("others"), F.col("c").alias("d"),
        )
        smaller = (F.col("less") < F.col("size")) | ((F.col("less") == F.col("size")) & (F.col("other") < F.col("comp")))
        pairs = large.join(small, ["key", "block"]).where(smaller & self._alike())
        return pairs.select(F.greatest("rid", "b").alias("a"), F.least("rid", "b").alias("b")).distinct()

    def resolved(self) -> DataFrame:
        """(_rid, _n, c_doc_id, comp): every row with the smallest class of its component."""
        labels = self.components()
        classes = stored(self.classes().join(labels, F.col("rid") == F.col("node"), "left").select("_digest", F.coalesce("comp", "rid").alias("comp")), "classes")
        forget(labels)
        rows = self.rows.select("_rid", "_n", "_digest", "c_doc_id").join(classes, "_digest", "left")
        out = stored(rows.select("_rid", "_n", "c_doc_id", F.coalesce("comp", "_rid").alias("comp")), "resolved")
        forget(classes)
        return out


def near_duplicates(docs: DataFrame, size: int = 2, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    run = NearCopies(docs, size, threshold, columns=["doc_id"])
    rows = run.resolved()
    low = stored(rows.groupBy("comp").agg(F.min("c_doc_id").alias("component_id")), "smallest")
    return rows.join(low, "comp", "left").select(
        F.col("c_doc_id").alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        "component_id",
        F.col("c_doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-copies: of each component the row with the smallest
    doc_id stays (of several rows with that id, one)."""
    run = NearCopies(docs, size, threshold)
    rows = run.resolved()
    smallest = stored(rows.groupBy("comp").agg(F.min("c_doc_id").alias("low")), "smallest")
    stays = rows.join(smallest, "comp").where(F.col("c_doc_id").eqNullSafe(F.col("low"))).groupBy("comp").agg(F.min("_rid").alias("_rid"))
    kept = run.rows.join(stored(stays.select("_rid"), "stays"), "_rid", "left_semi")
    return kept.select(*[F.col(f"`c_{c}`").alias(c) for c in docs.columns])
