"""Sharding over fixed virtual slots, in DataFrame functions alone.

A record's hash names one of thousands of slots for good. A map from slots to shards is kept
as a table of versions; the first deals slots in turn. Each run sums the bytes of the slots, edits the
latest version so that shards are even again, and stores it as the next one, so moving data means moving
whole slots. The map is the only thing the driver holds: a row for each slot, of which there is a fixed number.
"""

from __future__ import annotations

import bisect
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagflow.llm.shared import copies, shared_dir, written

SLOTS = 4096
LANE_ROWS = 50_000
MAP_SCHEMA = "version int, slot int, shard int"
MAP_CONF = "spark.tagflow.slot_map"  # where the query and the pipeline keep the map; unset: each run has its own


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def virtual_slot(doc_id: Column, crc: Column, slots: int = SLOTS) -> Column:
    """Of the id and the text's checksum, so that rows of one id, or of none, still spread."""
    return F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("-")), crc), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes of each slot in use; at most SLOTS numbers come to the driver."""
    return {r.virtual_slot: r.bytes for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()}


def plain_map(shards: int, slots: int = SLOTS) -> list[tuple[int, int]]:
    """The first version of a map, before any bytes are known: slots in turn."""
    return [(s, s % shards) for s in range(slots)]


def rebalanced(current: list[tuple[int, int]], sizes: dict[int, int], shards: int) -> list[tuple[int, int]]:
    """The map edited for shards shards. Slots of a shard that is no more go, the largest first, to the shard with the fewest
    bytes. Then, again and again, the shard with the most bytes gives to that with the fewest the slot whose size is nearest
    to half their difference, as long as one is smaller than that difference."""
    where = dict(current)
    load = [0] * shards
    for slot, shard in where.items():
        if shard < shards:
            load[shard] += sizes.get(slot, 0)
    for slot in sorted((s for s, k in where.items() if k >= shards), key=lambda s: (-sizes.get(s, 0), s)):
        where[slot] = load.index(min(load))
        load[where[slot]] += sizes.get(slot, 0)
    own: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in where.items():
        if sizes.get(slot, 0):
            own[shard].append((sizes[slot], slot))
    for found in own:
        found.sort()
    while True:
        giver, taker = load.index(max(load)), load.index(min(load))
        gap = load[giver] - load[taker]
        at = bisect.bisect(own[giver], (gap // 2, -1))
        fit = [x for x in own[giver][max(0, at - 1) : at + 1] if x[0] < gap]
        if not fit:
            return sorted(where.items())
        size, slot = move = min(fit, key=lambda x: (abs(2 * x[0] - gap), x))
        own[giver].remove(move)
        bisect.insort(own[taker], move)
        where[slot] = taker
        load[giver] -= size
        load[taker] += size


def map_table(like: DataFrame, pairs: list[tuple[int, int]], version: int) -> DataFrame:
    """The slot-to-shard map as a table with its version."""
    return like.sparkSession.createDataFrame([(version, s, k) for s, k in pairs], MAP_SCHEMA)


def stored_map(spark: SparkSession, path: str) -> tuple[int, list[tuple[int, int]]]:
    """The latest version of the map stored at path, and its pairs; 0 and none if nothing is there."""
    try:
        maps = spark.read.schema(MAP_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    version = maps.agg(F.max("version")).first()[0] or 0
    return version, sorted((r.slot, r.shard) for r in maps.where(F.col("version") == version).collect())


def edited_map(records: DataFrame, path: str, shards: int, slots: int = SLOTS) -> tuple[int, list[tuple[int, int]]]:
    """The map at path after this run: its latest version (the plain map is version 1 where there is none), edited by
    the bytes of records; where the edit moves a slot it is added as the next version."""
    spark = records.sparkSession
    version, current = stored_map(spark, path)
    if current and [s for s, _ in current] != list(range(slots)):
        raise ValueError(f"the map at {path} is not one of {slots} slots")
    store = lambda pairs, n: map_table(records, pairs, n).coalesce(1).write.mode("append").parquet(path)
    if not current:
        version, current = 1, plain_map(shards, slots)
        store(current, version)
    pairs = rebalanced(current, slot_bytes(records), shards)
    if pairs != current:
        version += 1
        store(pairs, version)
    return version, pairs


def sharded(docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    size: UTF-8 bytes of the text (null: none) plus 1. The shards have nearly equal bytes (law
    "bytes"), as near as whole slots allow. slot: the row's place in its shard, without gaps
    from 0, by virtual slot and then by hash of id and text. map_path: a table of all versions of the map
    (MAP_SCHEMA, all slots), which this run edits; without it a new one in the shared folder. One run at a time may
    use it. Equal rows take neighbouring places. Other columns are ignored; an empty table gives an empty result.
    """
    crc = text_crc(F.col("text"))
    # equal rows are one row with their number: a third of all rows may be copies of one
    records = written(
        docs.select("doc_id", text_size(F.col("text")).alias("one"), crc.alias("text_crc32")).groupBy("doc_id", "one", "text_crc32").agg(F.count("*").alias("n"))
        .withColumns({"size": F.col("one") * F.col("n"), "virtual_slot": virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots)}), "records")
    version, pairs = edited_map(records, map_path or f"{shared_dir(docs.sparkSession)}/tagflow/{uuid.uuid4().hex}/slot_map", shards, slots)
    where = written(map_table(records, pairs, version).select(F.col("slot").alias("virtual_slot"), "shard"), "slot_map")
    # places are counted in lanes, parts of a slot of about LANE_ROWS rows: the lanes before in the shard, then the place in the lane
    lanes = max(1, records.count() // (slots * LANE_ROWS))
    hashed = records.withColumn("h", F.xxhash64("doc_id", "text_crc32", "one")).withColumn("lane", F.pmod("h", F.lit(lanes)))
    counts = hashed.groupBy("virtual_slot", "lane").agg(F.sum("n").alias("n")).join(where, "virtual_slot")
    before = W.partitionBy("shard").orderBy("virtual_slot", "lane").rowsBetween(W.unboundedPreceding, -1)
    starts = written(counts.select("virtual_slot", "lane", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "slot_starts")
    inside = W.partitionBy("virtual_slot", "lane").orderBy("h", F.col("doc_id").asc_nulls_first(), "text_crc32", "one").rowsBetween(W.unboundedPreceding, -1)
    placed = hashed.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, ["virtual_slot", "lane"])
    return copies(placed, "n").select(
        "doc_id", F.col("one").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("place") + F.col("copy")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(version).alias("map_version"))
