"""Sharding over fixed virtual slots.

A record's slot is a hash of its identifier and text, one of ``SLOTS`` for ever. What
moves is the map from slots to shards: bytes are added up per slot, and the map
is a small table with a version, which a rebalancing edits: it moves the fewest
slots that even out the shards and leaves the others where they are. The map and
the sums per slot, ``SLOTS`` rows each, are all that the driver sees.

The law is ``bytes``: shards are near equal in bytes. Equal texts are spread by
their identifiers and different texts of one identifier by the texts, so neither a
large group of copies nor a frequent identifier meets in one slot.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm.common import kept, ranked
from marketbars.workspace import exists, new_folder

SLOTS = 8192
SHARDS = 16
TOLERANCE = 0.001  # of a shard's fair share

SlotMap = dict[int, int]


def virtual_slot(doc_id: Column, text: Column) -> Column:
    """Slot of a record, by identifier and text; null text counts as empty."""
    hashed = F.xxhash64(doc_id.cast("long"), F.coalesce(text, F.lit("")))
    return F.pmod(hashed, F.lit(SLOTS)).cast("int")


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes per virtual slot that holds any."""
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"))
    return {r["virtual_slot"]: r["size"] for r in sums.collect()}


def rebalanced(slots: SlotMap, sizes: dict[int, int], shards: int = SHARDS) -> SlotMap:
    """The map edited for ``shards`` shards and these sizes; an empty one is filled.

    Slots without a shard, or on one that is gone, go to the lightest shard,
    largest first. Then the heaviest and the lightest shard even out, by the slot
    or the exchange of two slots that comes nearest, until they are within the
    tolerance or nothing helps.
    """
    edited = {slot: slots[slot] for slot in range(SLOTS) if slots.get(slot, shards) < shards}
    loads = [0] * shards
    for slot, shard in edited.items():
        loads[shard] += sizes.get(slot, 0)
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    homeless = [slot for slot in range(SLOTS) if slot not in edited]
    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        edited[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), shard))
    loads = [0] * shards
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for slot, shard in edited.items():
        loads[shard] += sizes.get(slot, 0)
        held[shard][slot] = sizes.get(slot, 0)
    enough = TOLERANCE * sum(loads) / shards
    for _ in range(SLOTS):
        high, low = loads.index(max(loads)), loads.index(min(loads))
        half = (loads[high] - loads[low]) / 2
        if 2 * half <= enough:
            break
        fitting = [s for s, size in held[high].items() if 0 < size < 2 * half]
        best = min(fitting, key=lambda s: (abs(held[high][s] - half), s), default=None)
        gain = held[high][best] if best is not None else 0
        back = None
        if abs(gain - half) > half / 2 and gain < max(held[high].values()):
            pair = _exchange(held[high], held[low], half)
            if pair[0] is not None and abs(pair[2] - half) < abs(gain - half):
                best, back, gain = pair
        if best is None:
            break
        edited[best] = low
        held[low][best] = held[high].pop(best)
        if back is not None:
            edited[back] = high
            held[high][back] = held[low].pop(back)
        loads[high] -= gain
        loads[low] += gain
    return edited


def _exchange(high: dict[int, int], low: dict[int, int], half: float):
    """The pair of slots whose difference comes nearest to ``half``: two sorted lists swept."""
    ups, downs = (sorted(side, key=lambda s: (side[s], s)) for side in (high, low))
    best, found, k = half, (None, None, 0), 0
    for up in ups:
        while k + 1 < len(downs) and high[up] - low[downs[k]] > half:
            k += 1
        for down in downs[max(0, k - 1) : k + 1]:
            gain = high[up] - low[down]
            if gain > 0 and abs(gain - half) < best:
                best, found = abs(gain - half), (up, down, gain)
    return found


def store_map(spark: SparkSession, path: str, slots: SlotMap, version: int) -> None:
    """Add a version of the map to the table at ``path``; earlier ones stay."""
    rows = spark.createDataFrame(sorted(slots.items()), "virtual_slot int, shard int")
    rows.coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """virtual_slot, shard of one version, by default the latest."""
    stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version).select("virtual_slot", "shard")


def edited_map(
    spark: SparkSession, path: str, sizes: dict[int, int], shards: int = SHARDS
) -> DataFrame:
    """The latest map at ``path`` edited for these sizes, stored as its next version.

    Where there is none yet, the first is filled. A map that needs no edit stays.
    """
    version = 0
    if exists(spark, path):
        stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
        version = stored.agg(F.max("version")).first()[0] or 0
    old: SlotMap = {}
    if version:
        rows = load_map(spark, path, version).collect()  # SLOTS at most
        old = {r["virtual_slot"]: r["shard"] for r in rows}
    new = rebalanced(old, sizes, shards)
    if new != old:
        version += 1
        store_map(spark, path, new, version)
    return load_map(spark, path, version)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of every row."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), F.col("text")).alias("virtual_slot"),
    )


def shard(docs: DataFrame, shards: int = SHARDS, map_path: str | None = None) -> DataFrame:
    """Every row's shard and place in it, under the map at ``map_path``.

    A map that is there already is edited: the fewest slots move, and the result is its
    next version. Without a path the map is a new one.

    Size is the UTF-8 bytes of the text plus 1; null text has none. Rows that repeat id
    and text share a slot and count each; a null doc_id goes by its text; other columns
    are not read; an empty table gives no rows. ``grown_shard`` is null under
    this law. Places follow virtual slot, doc_id, checksum and size.
    """
    spark = docs.sparkSession
    rows = kept(sized(docs))
    path = map_path or new_folder(spark, "slot-map")
    slots = edited_map(spark, path, slot_bytes(rows), shards)
    # SLOTS bounds what is broadcast.
    mapped = rows.join(F.broadcast(slots), "virtual_slot")
    order = [F.col(c) for c in ("shard", "virtual_slot", "doc_id", "text_crc32", "size")]
    placed = ranked(mapped, *order)
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
