"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into a fixed number of virtual slots. Bytes and rows are summed
per slot, and a small map (one row per slot, with a version) says which shard
holds a slot. Rebalancing writes a new version that moves few slots; it never
changes a record's virtual slot.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.llm.common import prepare
from tabforge.session import cut_lineage

SLOTS = 4096
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long, n_rows long, first_slot long"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot per row, written once.

    A slot far above the mean in rows, or in bytes with more rows than one,
    comes from a doc_id (or NULL) that repeats, or from very long texts; its
    rows are dealt by row number over as many further slots, so their places
    may change with the partitions of the input. All other rows' slots follow
    from doc_id alone.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    base = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(docs["doc_id"].cast("long")), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    base = cut_lineage(base, "shard-records")
    per = slot_sizes(base)  # at most `slots` rows
    rows, weight = (sum(x[i] for x in per) / slots for i in (2, 1))
    hot = [s for s, size, n in per if n > 8 * rows + 1000 or n > 1 and size > 8 * weight + (1 << 20)]
    if hot:
        spread = (F.lit(slots) + F.pmod(F.xxhash64("doc_id", "row_no"), F.lit(slots))).cast("int")
        base = base.withColumn("virtual_slot", F.when(F.col("virtual_slot").isin(hot), spread)
                               .otherwise(F.col("virtual_slot")))
    return base


def slot_sizes(recs: DataFrame) -> list[tuple[int, int, int]]:
    """(virtual slot, bytes, rows); at most twice the fixed number of slots."""
    per = recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return sorted((r["virtual_slot"], r["bytes"], r["n"]) for r in per.collect())


def assign(sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """First map: the largest slot left goes to the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot, size, _ in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def rebalance(old: dict[int, int], sizes: list[tuple[int, int, int]], shards: int,
              tolerance: float = 0.01) -> dict[int, int]:
    """Next map version: slots leave only shards above the mean (or removed
    ones) and go to the lightest shard, until all are within ``tolerance``."""
    size = {s: b for s, b, _ in sizes}
    new = {s: old.get(s, -1) for s in size}
    load = [0] * shards
    homeless = []
    for s, shard in new.items():
        if 0 <= shard < shards:
            load[shard] += size[s]
        else:
            homeless.append(s)
    goal = sum(size.values()) / max(1, shards)
    for shard in range(shards):
        own = sorted((s for s in new if new[s] == shard), key=lambda s: (-size[s], s))
        for s in own:
            if load[shard] - goal <= tolerance * goal:
                break
            if load[shard] - size[s] >= goal * (1 - tolerance):
                load[shard] -= size[s]
                homeless.append(s)
    for s in sorted(homeless, key=lambda s: (-size[s], s)):
        shard = min(range(shards), key=lambda k: (load[k], k))
        new[s] = shard
        load[shard] += size[s]
    return new


def map_rows(mapping: dict[int, int], sizes: list[tuple[int, int, int]], version: int) -> list[tuple]:
    """Rows of the map table, with each slot's first place in its shard."""
    filled: dict[int, int] = {}
    out = []
    for slot, size, n in sorted(sizes):
        shard = mapping[slot]
        out.append((version, slot, shard, size, n, filled.get(shard, 0)))
        filled[shard] = filled.get(shard, 0) + n
    return out


def write_map(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Store map versions in the shared folder and read them back."""
    return cut_lineage(spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1), "shard-map")


def read_map(mapping: DataFrame, version: int) -> tuple[dict[int, int], list[tuple[int, int, int]]]:
    """One stored version: the slots' shards and their (slot, bytes, rows); bounded by the slots."""
    rows = mapping.where(F.col("version") == version).collect()
    return ({r["virtual_slot"]: r["shard"] for r in rows},
            sorted((r["virtual_slot"], r["bytes"], r["n_rows"]) for r in rows))


def edit_map(mapping: DataFrame, shards: int, tolerance: float = 0.01) -> DataFrame:
    """All stored versions and the next one, the latest rebalanced to ``shards`` shards, stored anew."""
    latest = mapping.agg(F.max("version")).first()[0]
    if latest is None:
        return mapping
    old, sizes = read_map(mapping, latest)
    rows = map_rows(rebalance(old, sizes, shards, tolerance), sizes, latest + 1)
    spark = mapping.sparkSession
    return cut_lineage(mapping.unionByName(spark.createDataFrame(rows, MAP_SCHEMA)).coalesce(1), "shard-map")


def place(recs: DataFrame, mapping: DataFrame, version: int) -> DataFrame:
    """shard and gapless ``slot`` (place in the shard, from 0) of each record by one map version."""
    # the map has at most twice the fixed number of slots
    current = mapping.where(F.col("version") == version).drop("bytes", "n_rows")
    joined = recs.join(F.broadcast(current), "virtual_slot")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "row_no")
    return joined.withColumn("slot", F.col("first_slot") + F.row_number().over(within) - 1)


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS) -> DataFrame:
    """Put every document into one of ``shards`` shards of near equal bytes.

    Law ``bytes``: size is the text's UTF-8 bytes plus 1 (NULL text: 1).
    Result: doc_id, size, text_crc32 (NULL text: 0), law, shard, slot (place
    in the shard, 0, 1, ... without gaps), grown_shard (NULL under this law),
    virtual_slot, map_version, next_shard (by the stored map's next version,
    edited for one more shard: only moved slots differ, and move into it or
    to a lighter shard). Repeated rows get places of their own; an empty
    table gives an empty result; further columns are ignored. Only narrow
    rows are shuffled, by virtual slot.
    """
    spark = docs.sparkSession
    prepare(spark)
    recs = records(docs, slots)
    sizes = slot_sizes(recs)
    mapping = edit_map(write_map(spark, map_rows(assign(sizes, shards), sizes, 1)), shards + 1)
    following = mapping.where("version = 2").select("virtual_slot", F.col("shard").alias("next_shard"))
    null: Column = F.lit(None).cast("int")
    return place(recs, mapping, 1).join(F.broadcast(following), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), null.alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"), "next_shard")


def shard_spread(placed: DataFrame) -> DataFrame:
    """Rows and bytes per shard."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("bytes"))


def near_equal(loads: list[int], tolerance: float = 0.05) -> bool:
    mean = sum(loads) / max(1, len(loads))
    return all(math.fabs(x - mean) <= tolerance * mean for x in loads)
