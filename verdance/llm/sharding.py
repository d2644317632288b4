"""Sharding by fixed virtual slots.

A record's id is hashed into one of ``SLOTS`` virtual slots; that never changes. Records and
bytes are added up per slot. A small table holds every slot with its shard, records and bytes;
its versions are kept side by side in the shared folder. Adding a shard or evening out bytes
edits the map into a new version and moves whole slots, no record is hashed again. A version has
``SLOTS`` rows whatever the data, so it may be broadcast and edited on the driver.

``law`` "key": the map for n shards is made by growing from one shard to n, each new shard
taking an equal number of slots from the others. So the id and the number of shards decide,
and one more shard takes rows only into itself. ``rebalanced`` goes on from such a stored map: it
moves slots by their bytes from full shards to empty ones, which that law rules out.

A record's place within its shard counts on from the records of the shard's earlier virtual
slots and, within a slot, of earlier sub-slots, which a hash of the text decides. So neither a
shard nor a slot is ever sorted as a whole; only rows with the same id and text must share a
sub-slot.

Defined cases: null text has no bytes and the checksum of the empty string; null ids share a
virtual slot and are numbered like others; repeated rows get places of their own; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdance.llm.common import forget, stored

SHARDS = 24
#: Fixed number of virtual slots; a power of two, thousands, far above any number of shards.
SLOTS = 4096
#: Pieces in which the records of one virtual slot are numbered.
SUB_SLOTS = 64
#: Bytes a record takes besides its text.
OVERHEAD = 8


def grown(slots: list[int], shards: int) -> list[int]:
    """The map for one more shard than ``shards``: the new one takes an equal number of slots
    from each, the highest-numbered first, the fullest shards giving first where it is uneven."""
    out, held = list(slots), {s: [] for s in range(shards)}
    for slot, shard in enumerate(slots):
        held[shard].append(slot)
    for _ in range(len(slots) // (shards + 1)):
        giver = max(held, key=lambda s: (len(held[s]), -s))
        out[held[giver].pop()] = shards
    return out


def slot_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Shard of each slot: the map of one shard, grown to ``shards``."""
    out = [0] * slots
    for n in range(1, shards):
        out = grown(out, n)
    return out


def rebalance(slots: list[int], sizes: list[int], shards: int) -> list[int]:
    """Moves slots, small ones first, from the shard with most bytes to the one with fewest as
    long as that brings the two closer."""
    out, load, held = list(slots), [0] * shards, {s: [] for s in range(shards)}
    for slot, shard in enumerate(slots):
        load[shard] += sizes[slot]
        held[shard].append(slot)
    for _ in range(len(slots)):
        full, empty = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        fits = [s for s in held[full] if 0 < sizes[s] < gap]
        if not fits:
            break
        slot = min(fits, key=lambda s: (abs(gap / 2 - sizes[s]), s))
        held[full].remove(slot)
        held[empty].append(slot)
        out[slot], load[full], load[empty] = empty, load[full] - sizes[slot], load[empty] + sizes[slot]
    return out


def virtual_slot(key, slots: int = SLOTS):
    """The slot of a key, from its text form alone."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("\0null"))), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_key, size, text_crc32, text_hash, vslot, sub) of each row."""
    content = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.xxhash64(content).alias("text_hash"),
        virtual_slot(F.col(key), slots).alias("vslot"),
    ).withColumn("sub", F.pmod("text_hash", F.lit(SUB_SLOTS)).cast("int"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """(vslot, sub, records, bytes) of ``records``: at most SLOTS * SUB_SLOTS rows. Stored."""
    return stored(rows.groupBy("vslot", "sub").agg(F.count("*").alias("records"), F.sum("size").alias("bytes")), "slot-bytes")


def map_table(spark: SparkSession, versions: dict[int, list[int]], held: DataFrame) -> DataFrame:
    """(version, vslot, shard, records, bytes), one row for each version and slot. Stored."""
    rows = [(v, slot, shard) for v, slots in versions.items() for slot, shard in enumerate(slots)]
    sums = held.groupBy("vslot").agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))
    named = spark.createDataFrame(rows, "version int, vslot int, shard int").join(sums, "vslot", "left")
    return stored(named.select("version", "vslot", "shard", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "bytes")]), "slot-map")


def stored_map(versions: DataFrame, version: int) -> tuple[list[int], list[int]]:
    """Shard and bytes of each slot in a stored version; one row per slot comes to the driver."""
    rows = versions.where(F.col("version") == version).orderBy("vslot").collect()
    return [r["shard"] for r in rows], [r["bytes"] for r in rows]


def rebalanced(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(map_version, vslot, shard, records, bytes): the stored map of ``shards`` shards as version 0,
    and as version 1 what ``rebalance`` makes of it. A slot is never split, so a shard keeps at
    least the bytes of its largest one."""
    spark = docs.sparkSession
    held = slot_bytes(records(docs, slots, key, text))
    first = map_table(spark, {0: slot_map(shards, slots)}, held)
    second = map_table(spark, {1: rebalance(*stored_map(first, 0), shards)}, held)
    forget(held)
    return first.unionByName(second).withColumnRenamed("version", "map_version")


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version) of each row;
    ``slot`` is the row's place within its shard, counted from 0."""
    now = slot_map(shards, slots)
    rows = records(docs, slots, key, text)
    held = slot_bytes(rows)
    versions = map_table(docs.sparkSession, {shards: now, shards + 1: grown(now, shards)}, held)
    # both have one row per virtual slot
    pair = versions.groupBy("vslot").agg(
        F.max(F.when(F.col("version") == shards, F.col("shard"))).alias("shard"),
        F.max(F.when(F.col("version") == shards + 1, F.col("shard"))).alias("grown_shard"),
    )
    # as many rows as there are sub-slots, whatever the data
    before = Window.partitionBy("shard").orderBy("vslot", "sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.join(pair, "vslot").select("vslot", "sub", "shard", "grown_shard", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("vslot", "sub").orderBy("_key", "text_hash", "text_crc32", "size")) - 1
    return (
        rows.withColumn("place", place)
        .join(F.broadcast(starts), ["vslot", "sub"])
        .select(
            F.col("_key").alias(key),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
            "grown_shard",
            "vslot",
            F.lit(shards).alias("map_version"),
        )
    )
