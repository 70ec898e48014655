"""Sharding by fixed virtual slots.

Records are hashed once into a fixed number of virtual slots.  Bytes and rows
are added up per slot (a partial aggregate; a slot count of a few thousand
bounds what reaches the driver).  A versioned slot-to-shard map decides where
each slot lives; rebalancing edits the map and never rehashes a record.

Edge cases: a null text weighs 1 byte (0 bytes plus 1); a null id hashes
together with the text's checksum; rows that are equal in every column share a
slot but get different positions; an empty table gives an empty result and the
even map; columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import number_in_groups
from tidemark.session import materialize, scratch_path

#: Fixed for the life of a data set: records are never rehashed.
SLOTS = 4096
#: Difference between the heaviest and the lightest shard, as a share of an equal one, up to which slots stay where they are.
SPREAD = 0.01


def virtual_slot(doc_id: Column, crc: Column, slots: int = SLOTS) -> Column:
    """The record's slot: from the id, or from the text's checksum where the id is null."""
    return F.pmod(F.xxhash64(doc_id, F.when(doc_id.isNull(), crc)), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every row."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       crc.cast("long").alias("text_crc32"), virtual_slot(F.col("doc_id"), crc, slots).alias("virtual_slot"))


def slot_totals(recs: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows): one row a slot that has records."""
    return recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def even_map(slots: int, shards: int) -> list[int]:
    """Version 0: slot s lives in shard s * shards // slots."""
    return [s * shards // slots for s in range(slots)]


def rebalance(slot_map: list[int], weight: dict[int, int], shards: int, spread: float = SPREAD) -> list[int]:
    """The next version of ``slot_map`` with shard weights near equal.

    A shard above an equal share gives up slots, heaviest first, as long as it
    stays at the share or above; what is given up goes, heaviest first, to the
    lightest shard, so new shards fill up first.  Where weights then still
    differ by more than ``spread`` of a share, slots move on between the
    heaviest and the lightest shard, the one nearest to half their difference
    first.  Other slots stay.  Works on a few thousand slots, whatever the
    number of records.
    """
    share = sum(weight.values()) / shards if shards else 0
    load, held, free = [0] * shards, [set() for _ in range(shards)], []
    for slot, shard in enumerate(slot_map):
        if shard < shards:
            load[shard] += weight.get(slot, 0)
            held[shard].add(slot)
        else:
            free.append(slot)

    def heaviest_first(slots: Iterable[int]) -> list[int]:
        return sorted(slots, key=lambda s: (-weight.get(s, 0), s))

    for shard in range(shards):
        for slot in heaviest_first(held[shard]):
            w = weight.get(slot, 0)
            if w and load[shard] - w >= share:
                load[shard] -= w
                held[shard].remove(slot)
                free.append(slot)
    heap = [(w, shard) for shard, w in enumerate(load)]
    heapq.heapify(heap)
    for slot in heaviest_first(free):
        w, shard = heapq.heappop(heap)
        held[shard].add(slot)
        load[shard] = w + weight.get(slot, 0)
        heapq.heappush(heap, (load[shard], shard))
    giving = set(range(shards))  # shards with a slot light enough to move on
    while giving:
        top, low = max(giving, key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[top] - load[low]
        if gap <= spread * share:
            break
        light = [s for s in held[top] if 0 < weight.get(s, 0) < gap]
        if not light:
            giving.remove(top)
            continue
        slot = min(light, key=lambda s: (abs(2 * weight[s] - gap), s))
        held[top].remove(slot)
        held[low].add(slot)
        load[top] -= weight[slot]
        load[low] += weight[slot]
    out = list(slot_map)
    for shard, slots in enumerate(held):
        for slot in slots:
            out[slot] = shard
    return out


def write_map(spark: SparkSession, path: str, version: int, slot_map: Iterable[int]) -> None:
    """Store one version of the map: (slot, shard) under ``path/version=N``; older versions stay readable."""
    rows = spark.createDataFrame([(s, int(x)) for s, x in enumerate(slot_map)], "virtual_slot int, shard int")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Every row with its virtual slot, shard and position in the shard (0, 1, 2, ... without gaps).

    Version 0 of the map is even; version 1 is edited by the bytes of each
    slot, and it is the one read back and applied.  Positions come from the
    slots' row counts plus a row number inside the slot, counted over range
    partitions that cut a slot where one id holds many rows: neither a shard
    nor a slot is ever sorted as a whole.
    """
    spark = docs.sparkSession
    path = map_path or scratch_path(spark, "slot-map")
    recs = materialize(records(docs, slots).withColumn("_row", F.monotonically_increasing_id()), "shard-records")
    totals = {r["virtual_slot"]: (r["bytes"], r["rows"]) for r in slot_totals(recs).collect()}  # at most ``slots`` rows
    write_map(spark, path, 0, even_map(slots, shards))
    first = [r["shard"] for r in read_map(spark, path, 0).orderBy("virtual_slot").collect()]
    edited = rebalance(first, {s: b for s, (b, _) in totals.items()}, shards)
    write_map(spark, path, 1, edited)
    starts, at = [], [0] * shards
    for slot, shard in enumerate(edited):
        starts.append((slot, at[shard]))
        at[shard] += totals.get(slot, (0, 0))[1]
    offsets = spark.createDataFrame(starts, "virtual_slot int, start long")
    located = F.broadcast(read_map(spark, path, 1).join(offsets, "virtual_slot"))  # ``slots`` rows
    numbered = number_in_groups(recs, ["virtual_slot"], ["doc_id", "text_crc32", "size", "_row"], "_n", group_bound=slots)
    return (numbered.join(located, "virtual_slot")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("_n") - 1).cast("long").alias("slot"),
                    "virtual_slot"))
