"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of ``BLOCK`` characters. All distinct blocks are sorted
by two 64-bit hashes, which tell any two of them apart (this is checked), and a block's name is its
place in that order, counted from 0. Then the names of adjacent blocks are
paired, the distinct pairs are sorted and named likewise, and so on until each text has a single
name. With the number of blocks it is the text's identity: equal texts have equal names, and
different texts never do. Names depend on the texts alone, not on partitions or runs. Sorting is by
ranges: a partition's places count on from the rows of those before it. The borders of ranges come
from a sample that Spark sends to the driver, so what is sorted has a fixed, small width.

Blocks meet their names by two 64-bit hashes, so block texts are shuffled once, after copies
within a task have fallen together. That no two different blocks share both hashes is checked
for every block while it is named; the job fails if one did. Names of each level are stored, so
they stay the same when an executor is lost. A text with one name left takes no part in later
levels, and a level works on half the rows of the one before.

Everything is DataFrame code.

Defined cases: null text counts as empty; texts without blocks have the name -1; of equal texts
the row with the smallest id stays, of repeated rows with that id one, and a null id counts as
larger than any other; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.llm.common import BLANKS, forget, fresh, row_id, stored

#: Characters of a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _blocks(text: Column, block: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block), F.lit(0))


def _hashes(block: Column) -> tuple[Column, Column]:
    return F.xxhash64(block).alias("h1"), F.xxhash64(F.lit(1), block).alias("h2")


def ranked(rows: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of distinct rows with ``name``, the row's place in the order of all. Stored."""
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    spread = stored(ranges.select(*keep, F.monotonically_increasing_id().alias("at")), "ranges")
    part = F.shiftright("at", 33)  # Spark puts the partition above the row's place within it
    # one row per partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spread.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    place = F.col("at") - F.shiftleft("part", 33)
    named = spread.withColumn("part", part).join(F.broadcast(starts), "part")
    out = stored(named.select(*keep, (F.col("start") + place).alias("name")), "names")
    forget(spread)
    return out


def block_names(texts: DataFrame, block: int) -> DataFrame:
    """(h1, h2, name) of all distinct blocks of the column ``norm``. Stored."""
    every = texts.select(F.explode(_blocks(F.col("norm"), block)).alias("block")).select("block", *_hashes(F.col("block")))
    met = every.groupBy("h1", "h2").agg(F.collect_set("block").alias("found"))
    whole = F.when(F.size("found") == 1, True).otherwise(F.raise_error(F.lit("two blocks share both hashes")))
    checked = met.where(whole)
    return ranked(checked.select("h1", "h2"), ["h1", "h2"], ["h1", "h2"])


def identities(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(rid, key, text_sha256, n_blocks, name) of each row. Stored."""
    names = block_names(docs.select(normalised(F.col(text)).alias("norm")), block)
    rows = stored(
        docs.select(row_id().alias("rid"), F.col(key).alias("_key"), normalised(F.col(text)).alias("norm")).select(
            "rid",
            "_key",
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("norm"), block), lambda b: F.struct(*_hashes(b))).alias("keys"),
        ),
        "rows",
    )
    keys = rows.select("rid", F.size("keys").alias("n_blocks"), F.posexplode("keys").alias("place", "k")).select(
        "rid", "n_blocks", "place", F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")
    )
    named = stored(keys.join(names, ["h1", "h2"]).select("rid", "n_blocks", "place", "name"), "level")
    done, spent, reach = [], [names], 1
    while True:
        done.append(named.where(F.col("n_blocks") <= reach).select("rid", "name"))
        spent.append(named)
        rest = named.where(F.col("n_blocks") > reach)
        if rest.isEmpty():
            break
        pairs = stored(
            rest.groupBy("rid", "n_blocks", F.expr("place div 2").cast("int").alias("place")).agg(
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("l"),
                F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r"),
            ),
            "pairs",
        )
        names = ranked(pairs.select("l", "r").distinct(), ["l", "r"], ["l", "r"])
        named = stored(pairs.join(names, ["l", "r"]).select("rid", "n_blocks", "place", "name"), "level")
        forget(pairs, names)
        reach *= 2
    last = done[0]
    for part in done[1:]:
        last = last.union(part)
    out = stored(
        rows.select("rid", F.col("_key").alias(key), "text_sha256", F.size("keys").alias("n_blocks"))
        .join(last, "rid", "left")
        .withColumn("name", F.coalesce("name", F.lit(-1))),
        "identities",
    )
    forget(rows, *spent)
    return out


def _groups(ids: DataFrame, key: str) -> DataFrame:
    """(n_blocks, name, group_size, keep_id, keep_rid). Stored."""
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("rid")))
    return stored(
        ids.groupBy("n_blocks", "name")
        .agg(F.count("*").alias("group_size"), first.alias("first"))
        .select("n_blocks", "name", "group_size", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid")),
        "groups",
    )


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row of ``docs``."""
    ids = identities(docs, block=block)
    groups = _groups(ids, "doc_id")
    return ids.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay. They are found again by id and digest; of repeated rows
    with the same id one stays."""
    ids = identities(docs, block=block)
    groups = _groups(ids, "doc_id")
    mark = lambda key, digest: F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("-")), digest)
    name, number = fresh(docs.columns, "_mark"), fresh(docs.columns, "_number")
    stays = stored(
        ids.join(groups, ["n_blocks", "name"]).where("rid = keep_rid").select(mark(F.col("doc_id"), F.col("text_sha256")).alias(name)),
        "stays",
    )
    forget(ids, groups)
    marked = docs.withColumn(name, mark(F.col("doc_id"), F.sha2(normalised(F.col("text")), 256)))
    one = F.row_number().over(Window.partitionBy(name).orderBy(name))
    kept = marked.join(stays, name, "left_semi").withColumn(number, one).where(F.col(number) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
