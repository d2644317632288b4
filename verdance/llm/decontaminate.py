"""Benchmark decontamination: size-partitioned MinHash containment search.

Words are the lower-cased runs of letters and digits; an item's set is that of its distinct
shingles of five words (an item with fewer words is one shingle of that length). A document
leaks an item if it contains at least 80 of 100 of the item's shingles, however long it is.

Items are partitioned by the size of their sets. Within a partition an item's sketch holds the
smallest hashes of its set, as many as the partition's largest item may miss plus one, and all
of them where the set has no more. A document with enough of the item must contain one of the
sketch, so the search for a shared hash loses nothing; a document with fewer words than any
item of the partition needs is not a candidate. Candidates are then settled on the exact
shingles.

The sketch is broadcast while it has at most ``SKETCH_MOST`` rows of three numbers; beyond that
the hashes are joined by a shuffle. Everything is DataFrame code; shingles of documents are
hashed in generated code and never stored.

Defined cases: null and empty texts and items without a word contain and leak nothing; documents
of equal ids with different texts are told apart by the text's hash, items of equal or null ids
by a number, so each has a sketch of its own; repeated rows give one row per
(doc_id, item_id); null ids take part like others; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.llm.common import forget, fresh, row_id, stored

SIZE = 5
#: Percent of an item's shingles.
THRESHOLD = 80
SKETCH_MOST = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _shingles(rows: DataFrame, size: int) -> DataFrame:
    """One row for each place at which a shingle of ``size`` words starts, with the hash of the
    words' hashes. Numbers only: a place costs no text."""
    placed = rows.where(F.size("hashes") >= size).withColumn("at", F.explode(F.sequence(F.lit(1), F.size("hashes") - (size - 1))))
    return placed.withColumn("h", F.xxhash64(F.slice("hashes", F.col("at"), size)))


def _texts(of: Column, size: Column) -> Column:
    """The distinct shingles of an array of words, as texts."""
    last = F.size(of) - size
    every = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.array_join(F.slice(of, i, size), " "))
    return F.when(last >= 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def item_sets(items: DataFrame, size: int = SIZE) -> DataFrame:
    """(item, item_id, words, k, n, shingles): the set of each row, numbered by ``item``. Stored."""
    rows = items.select(row_id().alias("item"), "item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    rows = rows.withColumn("k", F.least(F.size("words"), F.lit(size)))
    rows = rows.withColumn("shingles", _texts(F.col("words"), F.col("k")))
    return stored(rows.select("item", "item_id", "words", "k", F.size("shingles").alias("n"), "shingles"), "items")


def sketches(sets: DataFrame, lengths: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """(k, h, item, words_needed) of each item's smallest hashes. Stored."""
    sized = sets.withColumn("part", F.floor(F.log2("n")).cast("int"))
    # ceil(n * threshold / 100) shingles suffice, so this many may be missing
    missing = lambda n: n - F.ceil(n * threshold / 100)
    bounds = sized.groupBy("part").agg(F.max("n").alias("largest"), F.min("n").alias("least"))
    sized = sized.join(bounds, "part").select(
        "item",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        "k",
        (missing(F.col("largest")) + 1).alias("keep"),
        (F.ceil(F.col("least") * threshold / 100) + F.col("k") - 1).cast("int").alias("words_needed"),
    )
    hashed = [_shingles(sized.where(F.col("k") == k), k) for k in lengths]
    every = reduce(DataFrame.unionByName, hashed).select("item", "k", "keep", "words_needed", "h").distinct()
    low = F.row_number().over(Window.partitionBy("item").orderBy("h"))
    return stored(every.withColumn("low", low).where("low <= keep").select("k", "h", "item", "words_needed"), "sketch")


def leaks(docs: DataFrame, items: DataFrame, size: int = SIZE, threshold: int = THRESHOLD, sketch_most: int = SKETCH_MOST) -> DataFrame:
    """(doc_id, text_hash, item_id, n, shared) of each row and item it leaks. Stored."""
    items = items.groupBy("item_id", "text").count()
    sets = item_sets(items, size)
    lengths = [r[0] for r in sets.select("k").distinct().orderBy("k").collect()]  # at most ``size`` values
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    if not lengths:
        empty = rows.where(F.lit(False)).select("doc_id", "text_hash")
        return stored(empty.crossJoin(sets.select("item_id", "n").limit(0)).withColumn("shared", F.lit(0)), "leaks")
    sketch = sketches(sets, lengths, threshold)
    side = F.broadcast(sketch) if sketch.count() <= sketch_most else sketch
    hashed_words = rows.select("doc_id", "text_hash", word_hashes(F.col("text")).alias("hashes"))
    found = []
    for k in lengths:
        hashed = _shingles(hashed_words, k).select("doc_id", "text_hash", F.size("hashes").alias("n_words"), "h")
        hits = hashed.join(side.where(F.col("k") == k), "h").where("n_words >= words_needed")
        found.append(hits.select("doc_id", "text_hash", "item"))
    candidates = stored(reduce(DataFrame.union, found).distinct(), "candidates")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_hash") == F.col("c.text_hash"))
    texts = rows.alias("d").join(candidates.alias("c"), same).select("d.doc_id", "d.text_hash", "c.item", words(F.col("d.text")).alias("doc_words")).alias("t")
    both = texts.join(sets.alias("s"), F.col("t.item") == F.col("s.item"))
    shared = F.size(F.array_intersect("shingles", _texts(F.col("doc_words"), F.col("k"))))
    out = stored(
        both.select("t.doc_id", "text_hash", "s.item_id", "n", shared.alias("shared"))
        .where(F.col("shared") * 100 >= F.col("n") * threshold),
        "leaks",
    )
    forget(sets, sketch, candidates)
    return out


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment): every leaked item."""
    found = leaks(docs, items)
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("containment"), "n", "shared")).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n").cast("long").alias("item_shingles"),
            F.col("best.shared").cast("long").alias("shared_shingles"),
            "best.containment",
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item."""
    bad_id, bad_hash = fresh(docs.columns, "_bad_id"), fresh(docs.columns, "_bad_hash")
    bad = leaks(docs, items).select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    bad = stored(bad, "bad")
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.xxhash64("text") == F.col(bad_hash))
    return docs.join(bad, same, "left_anti")
