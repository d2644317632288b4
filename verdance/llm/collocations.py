"""Phrase collocations of each language, from weighted automata of word sequences.

Words: A-Z in lower case, pieces between ``.,;:!?`` and line ends, runs of anything but blanks
within pieces. f(phrase) counts all contiguous occurrences within pieces.

1. Words and pairs. A shard (some MB of text of one language) counts its sequences, sorts them,
   cuts them at the borders of prefix ranges and builds one automaton per range. All automata of
   a range meet in one place, are added up one after the other, and keep what occurs often enough.
2. Triples and fours, the same way, of pairs that occur often enough: no phrase is commoner than
   its parts, so this leaves nothing out. The frequent pairs reach the tasks as a bitmap of fixed
   size; a pair it holds by accident is counted and falls out when weights are summed.
3. Every candidate asks for the counts of its parts. Requests go to the range of the part, where
   an automaton of them is composed with the automaton of counts.
4. One grouping brings a candidate's count, its parts' counts and the count of its commonest
   longer candidate together.

The borders of ranges come from a bounded sample of rows; they place work and change no result.
Broadcast: the borders (at most RANGES_MOST of 256 bytes) and the bitmap (FILTER_BITS).

Defined cases: null language is ``und``; null, empty and blank texts have no word; repeated rows
count each time; ties go by the order stated in ``collocations``; an empty table gives none. A
language whose phrases are all rare gives no row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdance.llm.automata import Automaton, binaries, build, cuts, numbered, union
from verdance.llm.common import forget, small_batches, stored

LONGEST = 4
LEAST, MOST, SCALE = 30, 2000, 2_000_000
#: A candidate falls to a longer one that has at least this percentage of its occurrences.
WITHIN = 80
#: Bytes of text that a shard counts at once.
SHARD_BYTES = 16 << 20
#: Text bytes whose sequences one range may hold, by the sample; ranges at most.
RANGE_BYTES, RANGES_MOST = 64 << 20, 65_536
SAMPLE_ROWS, SAMPLE_GRAMS, BORDER_BYTES = 2000, 16, 64
FILTER_BITS = 1 << 27
#: Ways that the requests for one range are dealt out.
SALTS = 8
#: Bytes of automata that are added up at once.
UNION_BYTES = 8 << 20

SECTION = "range int, lang string, words long, grams binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\x0a\x0b\x0c\x0d"]] = 2


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words sorted by bytes, place of each word, whether the next word follows in
    the same piece) of texts without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held and len(texts) else np.zeros(0, np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    head = np.zeros(len(data) + 1, bool)
    head[offsets - offsets[0]] = True  # where a text begins, and the end
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | head[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | head[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    broken = np.cumsum((kind == 2) | head[:-1], dtype=np.int32)[starts]
    symbols, place = numbered(binaries(_LOWER[data[inside]], stops - starts))
    return symbols, place, broken[1:] == broken[:-1]


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language each, about ``most`` bytes at a time."""
    held: dict[str, list[pa.Array]] = {}
    size = 0
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1)
        for lang in langs.unique().to_pylist():
            own = texts.filter(pc.equal(langs, lang))
            held.setdefault(lang, []).append(own)
            size += own.nbytes
        if size >= most:
            yield from ((lang, pa.concat_arrays(x)) for lang, x in held.items())
            held, size = {}, 0
    yield from ((lang, pa.concat_arrays(x)) for lang, x in held.items())


def short_grams(place: np.ndarray, joined: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and pairs, sorted, and how often each occurs."""
    wide = np.int64(size + 1)
    single = np.bincount(place, minlength=size)
    at = np.flatnonzero(joined)
    pairs, times = np.unique(place[at] * wide + place[at + 1] + 1, return_counts=True)
    keys = np.concatenate([np.arange(size) * wide, pairs])
    order = np.argsort(keys, kind="stable")
    grams = np.stack([keys // wide, keys % wide - 1], axis=1).astype(np.int32)[order]
    return grams, np.concatenate([single, times])[order].astype(np.int64)


def long_grams(place: np.ndarray, good: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Triples and fours all of whose pairs are ``good`` (by the place of the first word),
    sorted, and how often each occurs."""
    wide = np.int64(size + 1)
    three = np.flatnonzero(good[:-1] & good[1:])
    if not len(three):
        return np.zeros((0, LONGEST), np.int32), np.zeros(0, np.int64)
    pairs, pair = np.unique(place[three] * wide + place[three + 1], return_inverse=True)
    triples, triple = np.unique(pair * wide + place[three + 2], return_inverse=True)
    further = np.zeros(len(three), bool)
    further[:-1] = (three[1:] == three[:-1] + 1) & good[np.minimum(three[:-1] + 2, len(good) - 1)]
    four = triple[further] * wide + place[three[further] + 3] + 1
    keys, times = np.unique(np.concatenate([triple * wide, four]), return_counts=True)
    third = triples[keys // wide]
    first = pairs[third // wide]
    grams = np.stack([first // wide, first % wide, third % wide, keys % wide - 1], axis=1)
    return grams.astype(np.int32), times.astype(np.int64)


def _hashes(symbols: pa.Array, lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in symbols.to_pylist()], np.uint64)


def _bit(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Place of a pair in the bitmap, from the hashes of its words."""
    x = (first ^ (first >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + second
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


def _sections(batches: Iterator[pa.RecordBatch], borders: list[tuple[bytes, ...]], bitmap) -> Iterator[pa.RecordBatch]:
    """One automaton per shard and range: of words and pairs, or with the bitmap of frequent
    pairs of triples and fours."""
    for lang, texts in _shards(batches, SHARD_BYTES):
        symbols, place, joined = words_of(texts)
        if not len(place):
            continue
        if bitmap is None:
            grams, weights = short_grams(place, joined, len(symbols))
        else:
            bits = bitmap.value
            h = _hashes(symbols, lang)
            good = np.append(joined, False)
            at = np.flatnonzero(joined)
            spot = _bit(h[place[at]], h[place[at + 1]], len(bits) * 8)
            good[at] = bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1
            grams, weights = long_grams(place, good, len(symbols))
        key = lang.encode("utf-8", "surrogatepass")
        low, high = bisect_left(borders, (key,)), bisect_left(borders, (key + b"\0",))
        edges = [0, *cuts(symbols.to_pylist(), grams, [b[1:] for b in borders[low:high]]), len(grams)]
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                part = build(symbols, grams[a:b], weights[a:b]).trimmed()
                yield pa.RecordBatch.from_pylist(
                    [{"range": low + i, "lang": lang, "words": int(weights[a:b][grams[a:b, 1] < 0].sum()), "grams": part.to_bytes()}],
                    schema=_SECTION,
                )


_SECTION = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("words", pa.int64()), ("grams", pa.binary())])


def _summed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Automata of a range and language, which follow each other, added up as they come; what
    occurs less than ``least`` times falls out at the end."""
    now, words, held, size = None, 0, [], 0

    def leave():
        whole = (union(held) if len(held) > 1 else held[0]).pruned(least)
        return pa.RecordBatch.from_pylist([{"range": now[0], "lang": now[1], "words": words, "grams": whole.to_bytes()}], schema=_SECTION)

    for batch in batches:
        for row in batch.to_pylist():
            if now != (row["range"], row["lang"]):
                if held:
                    yield leave()
                now, words, held, size = (row["range"], row["lang"]), 0, [], 0
            words += row["words"]
            held.append(Automaton.from_bytes(row["grams"]))
            size += len(row["grams"])
            if size >= UNION_BYTES and len(held) > 1:
                held = [union(held)]
                size = 0
    if held:
        yield leave()


def _counted(texts: DataFrame, borders: list[tuple[bytes, ...]], least: int, bitmap=None) -> DataFrame:
    return (
        texts.mapInArrow(lambda it: _sections(it, borders, bitmap), SECTION)
        .repartition("range")
        .sortWithinPartitions("range", "lang")
        .mapInArrow(lambda it: _summed(it, least), SECTION)
    )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Evenly spaced sequences, SAMPLE_GRAMS for each text, and the bytes they come from."""
    for lang, texts in _shards(batches, SHARD_BYTES):
        symbols, place, joined = words_of(texts)
        at = np.unique(np.linspace(0, len(place) - 1, SAMPLE_GRAMS * len(texts)).astype(int)) if len(place) else np.zeros(0, int)
        on, columns = np.ones(len(at), bool), []
        for k in range(LONGEST):
            if k:
                on = on & (at + k < len(place))
                on[on] = joined[at[on] + k - 1]
            words = symbols.take(pa.array(place[np.where(on, at + k, 0)] if len(at) else at)).to_pylist()
            columns.append([w[:BORDER_BYTES] if o else None for w, o in zip(words, on.tolist(), strict=True)])
        grams = [b" ".join(w for w in g if w is not None) for g in zip(*columns, strict=True)]
        sizes = [texts.nbytes] + [0] * len(grams)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(sizes)), pa.array(sizes, pa.int64()), pa.array([b"", *grams], pa.binary())], names=["lang", "size", "gram"]
        )


def range_borders(texts: DataFrame, range_bytes: int = RANGE_BYTES) -> list[tuple[bytes, ...]]:
    """Sorted (language, words..) between prefix ranges that hold about equally many sequences,
    from a sample of about SAMPLE_ROWS rows."""
    rows = texts.count()
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    sample = texts.sample(share, seed=7) if share < 1 else texts
    found = sample.mapInArrow(_sampled, "lang string, size long, gram binary").collect()
    size = sum(r["size"] for r in found) / share
    ranges = int(min(RANGES_MOST, max(size / range_bytes, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    grams = sorted((r["lang"].encode("utf-8", "surrogatepass"), *bytes(r["gram"]).split(b" ")) for r in found if r["gram"])
    return sorted({grams[i * len(grams) // ranges] for i in range(1, ranges)}) if grams else []


def _pair_bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            a = Automaton.from_bytes(row["grams"])
            grams, _ = a.paths()
            grams = grams[(grams >= 0).sum(axis=1) == 2]
            if not len(grams):
                continue
            h = _hashes(a.symbols, row["lang"])
            spot = np.unique(_bit(h[grams[:, 0]], h[grams[:, 1]], bits))
            slot, at = np.unique(spot >> 6, return_index=True)
            held = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (spot & 63).astype(np.uint64)), at)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(held.view(np.int64))], names=["slot", "held"])


def pair_filter(counts: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap with a bit for each pair in ``counts``; ``bits`` is a power of two."""
    slots = counts.mapInArrow(lambda it: _pair_bits(it, bits), "slot int, held long").groupBy("slot").agg(F.bit_or("held").alias("held")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[slots.column("slot").to_numpy()] = slots.column("held").to_numpy()
    return out.view(np.uint8)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, phrase, words, occurrences) of phrases of two words and more."""
    for batch in batches:
        for row in batch.to_pylist():
            a = Automaton.from_bytes(row["grams"])
            grams, weights = a.paths()
            n = (grams >= 0).sum(axis=1)
            grams, weights, n = grams[n > 1], weights[n > 1], n[n > 1]
            names = a.symbols.to_pylist()
            phrases = [b" ".join(names[p] for p in g[:k]).decode("utf-8", "surrogatepass") for g, k in zip(grams.tolist(), n.tolist(), strict=True)]
            for i in range(0, len(phrases), 8192):
                part = phrases[i : i + 8192]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(part)), pa.array(part, pa.string()), pa.array(weights[i : i + 8192])], names=["lang", "phrase", "a"]
                )


def _routed(batches: Iterator[pa.RecordBatch], borders: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
    """A request for each part of each cut, with the part's range."""
    for batch in batches:
        out = []
        for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = phrase.split(" ")
            key = lang.encode("utf-8", "surrogatepass")
            coded = [w.encode("utf-8", "surrogatepass") for w in words]
            for cut in range(1, len(words)):
                for side, part, held in (("l", words[:cut], coded[:cut]), ("r", words[cut:], coded[cut:])):
                    out.append((bisect_right(borders, (key, *held)), lang, phrase, f"{side}{cut}", " ".join(part)))
        cols = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.string()) for c in cols[1:])], names=["range", "lang", "phrase", "slot", "part"]
        )


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, salt and language the automata of counts come first, then the requests, a
    batch at a time: their automaton is composed with each of the counts."""
    now, counts = None, []
    for batch in batches:
        rows, asked = batch.to_pylist(), {}
        for row in rows:
            key = (row["range"], row["salt"], row["lang"])
            if key != now:
                yield from _composed(now, counts, asked)
                now, counts, asked = key, [], {}
            if row["grams"] is not None:
                counts.append(Automaton.from_bytes(row["grams"]))
            else:
                asked.setdefault(row["part"], []).append((row["phrase"], row["slot"]))
        yield from _composed(now, counts, asked)


def _composed(key, counts: list[Automaton], asked: dict[str, list]) -> Iterator[pa.RecordBatch]:
    if not asked:
        return
    parts = [[w.encode("utf-8", "surrogatepass") for w in p.split(" ")] for p in asked]
    symbols, place = numbered(pa.array([w for p in parts for w in p], pa.binary()))
    grams, at = np.full((len(parts), LONGEST), -1, np.int32), 0
    for i, p in enumerate(parts):
        grams[i, : len(p)] = place[at : at + len(p)]
        at += len(p)
    requests = build(symbols, grams[np.lexsort(grams.T[::-1])], np.ones(len(grams), np.int64))
    names, out = symbols.to_pylist(), []
    for a in counts:
        met, weights = a.compose(requests)
        for g, f in zip(met.tolist(), weights.tolist(), strict=True):
            part = b" ".join(names[p] for p in g if p >= 0).decode("utf-8", "surrogatepass")
            out += [(key[2], phrase, slot, f) for phrase, slot in asked[part]]
    cols = list(zip(*out, strict=True)) or [()] * 4
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.int64())], names=["lang", "phrase", "slot", "f"]
    )


def _part_counts(candidates: DataFrame, counts: DataFrame, borders: list[tuple[bytes, ...]]) -> DataFrame:
    """(lang, phrase, slot, f): f of the first ("l1"..) and second part ("r1"..) of each cut."""
    requests = candidates.select("lang", "phrase").mapInArrow(
        lambda it: _routed(it, borders), "range int, lang string, phrase string, slot string, part string"
    ).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).withColumn("grams", F.lit(None).cast("binary"))
    held = counts.select("range", "lang", *[F.lit(None).cast("string").alias(c) for c in ("phrase", "slot", "part")], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "grams")
    return (
        held.unionByName(requests)
        .repartition("range", "salt")
        .sortWithinPartitions("range", "salt", "lang", F.col("grams").isNull())
        .mapInArrow(_answered, "lang string, phrase string, slot string, f long")
    )


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most: int = MOST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the first ``most`` phrases of each language by
    score and a falling, then the phrase's bytes.

    a: occurrences; l, r: occurrences of the two parts of the cut with the lowest
    score = floor(2000000 * a / (l + r)), of equal ones the earliest; n: words of the language.
    A phrase of 2 to 4 words is a candidate with a >= ``least``, and falls if a longer candidate
    holds its words with at least 80% of its occurrences.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang")).where("text is not null")
    borders = range_borders(texts)
    short = stored(_counted(texts, borders, least), "pairs")
    bitmap = spark.sparkContext.broadcast(pair_filter(short, filter_bits))
    long = stored(_counted(texts, borders, least, bitmap), "fours")
    bitmap.unpersist()
    counts = short.unionByName(long)
    candidates = stored(counts.mapInArrow(_listed, "lang string, phrase string, a long"), "candidates")
    parts = stored(_part_counts(candidates, counts, borders), "parts")

    words = F.split("phrase", " ")
    inner = [
        F.when(F.size(words) > max(size, first + size - 2), F.array_join(F.slice(words, first, size), " "))
        for size in range(2, LONGEST)
        for first in range(1, LONGEST - size + 2)
    ]
    inside = candidates.select("lang", F.explode(F.array_compact(F.array(*inner))).alias("phrase"), F.col("a").alias("longer"))
    none = F.lit(None).cast("long")
    met = (
        candidates.select("lang", "phrase", "a", none.alias("longer"), F.lit(None).cast("string").alias("slot"), none.alias("f"))
        .unionByName(inside.select("lang", "phrase", none.alias("a"), "longer", F.lit(None).cast("string").alias("slot"), none.alias("f")))
        .unionByName(parts.select("lang", "phrase", none.alias("a"), none.alias("longer"), "slot", "f"))
        .groupBy("lang", "phrase")
        .agg(
            F.max("a").alias("a"),
            F.max("longer").alias("longer"),
            *[F.max(F.when(F.col("slot") == f"{s}{k}", F.col("f"))).alias(f"{s}{k}") for k in range(1, LONGEST) for s in "lr"],
        )
        .where(f"a is not null and (longer is null or 100 * longer < {WITHIN} * a)")
    )
    score = lambda k: f"(cast({SCALE} as decimal(10, 0)) * cast(a as decimal(19, 0))) div (l{k} + r{k})"
    best = F.array_min(F.array_compact(F.array(*[
        F.expr(f"if(l{k} is null, null, struct({score(k)} as score, {k} as k, l{k} as l, r{k} as r))") for k in range(1, LONGEST)
    ])))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = (
        met.select("lang", "phrase", "a", best.alias("best")).select("lang", "phrase", "a", "best.score", "best.l", "best.r")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    )
    sizes = short.groupBy("lang").agg(F.sum("words").alias("n"))
    out = stored(first.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    forget(short, long, candidates, parts)
    return out
