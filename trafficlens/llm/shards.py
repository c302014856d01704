"""Sharding over fixed virtual slots.

A row's virtual slot is a hash of its doc_id (of its text where that is null)
modulo ``SLOTS`` (thousands, fixed for the life of the corpus). Bytes per slot are
one aggregate; the slot map, one row per slot, says which shard holds it. The map
is versioned: each version is written as a new folder. Version 1 deals the slots
evenly, before any bytes are known; ``sharded`` reads the last version, rebalances
it for the bytes there now, moving as few slots as it can, and writes the
edited map as the next version. Law ``bytes``: shard sizes are near equal.

Only the slot table (SLOTS rows) reaches the driver. A row's size is the UTF-8
bytes of its text (null: none) plus one. Within a shard rows are numbered
without a gap: by slot, then by cell, then by doc_id; repeated rows one after the
other. A slot has one cell for about every ``CELL_ROWS`` rows, so that no task orders
a whole slot of a very large corpus.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from trafficlens.llm.common import stored

SLOTS = 4096
CELL_ROWS = 250_000
# shards may be off the mean by this share before slots move
SLACK = 0.001


def sized(docs: DataFrame, slots: int = SLOTS, cells: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, vslot, cell."""
    t = F.coalesce(F.col(text), F.lit(""))
    own = F.col(doc_id).cast("string")
    slot = F.when(own.isNotNull(), F.xxhash64(F.lit("slot"), own)).otherwise(F.xxhash64(F.lit("text"), t))
    return docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"), F.pmod(slot, F.lit(slots)).cast("int").alias("vslot"),
                       F.pmod(F.xxhash64(F.lit("cell"), slot), F.lit(cells)).cast("int").alias("cell"))


def slot_sizes(cells: DataFrame) -> dict[int, int]:
    """Bytes per slot that has rows."""
    return {r["vslot"]: r["bytes"] for r in cells.groupBy("vslot").agg(F.sum("bytes").alias("bytes")).collect()}


def first_map(sizes: dict[int, int], n_shards: int, slots: int = SLOTS) -> list[int]:
    """Slots by falling size, each to the shard that has least so far."""
    shard_of = [0] * slots
    heap = [(0, 0, s) for s in range(n_shards)]
    for v in sorted(range(slots), key=lambda v: (-sizes.get(v, 0), v)):
        held, n, s = heapq.heappop(heap)
        shard_of[v] = s
        heapq.heappush(heap, (held + sizes.get(v, 0), n + 1, s))
    return shard_of


def rebalanced(shard_of: list[int], sizes: dict[int, int], n_shards: int, slack: float = 0.01) -> list[int]:
    """An edited map: slots move from shards over the mean to shards under it,
    only as long as that evens them out; shards that no longer exist are emptied."""
    out = list(shard_of)
    held = [0] * n_shards
    own: list[list[int]] = [[] for _ in range(n_shards)]
    homeless = []
    for v, s in enumerate(out):
        if s < n_shards:
            held[s] += sizes.get(v, 0)
            own[s].append(v)
        else:
            homeless.append(v)
    for v in sorted(homeless, key=lambda v: (-sizes.get(v, 0), v)):
        s = min(range(n_shards), key=lambda s: (held[s], s))
        out[v] = s
        held[s] += sizes.get(v, 0)
        own[s].append(v)
    mean = sum(held) / n_shards
    for s in own:
        s.sort(key=lambda v: (sizes.get(v, 0), v))
    while True:
        top = max(range(n_shards), key=lambda s: (held[s], -s))
        low = min(range(n_shards), key=lambda s: (held[s], s))
        if held[top] <= mean * (1 + slack) and held[low] >= mean * (1 - slack):
            return out
        room = held[top] - held[low]
        # the largest slot whose move leaves the two nearer to each other
        fits = [v for v in own[top] if 0 < sizes.get(v, 0) < room]
        if not fits:
            return out
        v = min(fits, key=lambda v: (abs(2 * sizes.get(v, 0) - min(room, 2 * (mean - held[low]))), v))
        out[v] = low
        own[top].remove(v)
        own[low].append(v)
        held[top] -= sizes.get(v, 0)
        held[low] += sizes.get(v, 0)


def save_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Write a version of the map; an existing version is never overwritten."""
    rows = spark.createDataFrame([(version, v, s) for v, s in enumerate(shard_of)], "version long, vslot int, shard int")
    rows.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int").parquet(f"{path}/version={version}")


def last_version(spark: SparkSession, path: str) -> int:
    """The number of the last map written under ``path``; 0 without one."""
    try:
        maps = spark.read.schema("vslot int, shard int, version long").option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return maps.agg(F.max("version")).first()[0] or 0


def edited_map(spark: SparkSession, path: str, sizes: dict[int, int], n_shards: int, slots: int = SLOTS) -> int:
    """Rebalance the last map under ``path`` for the bytes per slot and write the
    outcome as the next version (none if no slot has to move). Returns the version
    that holds."""
    version = last_version(spark, path)
    if not version:
        version = 1
        save_map(spark, path, version, first_map({}, n_shards, slots))
    held = {r["vslot"]: r["shard"] for r in load_map(spark, path, version).collect()}
    held = [held[v] for v in range(slots)]
    new = rebalanced(held, sizes, n_shards, SLACK)
    if new == held:
        return version
    save_map(spark, path, version + 1, new)
    return version + 1


def placed(rows: DataFrame, slot_map: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` with their shard and gapless slot in it. ``cells`` has the number
    ``n`` of rows of each cell of a slot."""
    before = Window.partitionBy("shard").orderBy("vslot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(cells, "vslot").select("vslot", "cell", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    in_cell = Window.partitionBy("vslot", "cell").orderBy("doc_id", "size", "text_crc32")
    own = rows.withColumn("place", F.row_number().over(in_cell) - 1)
    return own.join(starts, ["vslot", "cell"]).withColumn("slot", (F.col("start") + F.col("place")).cast("long"))


def sharded(docs: DataFrame, map_path: str, n_shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """Shards of all rows by the slot map under ``map_path``, which is made or
    rebalanced first: doc_id, size, text_crc32, vslot, shard, slot."""
    spark = docs.sparkSession
    rows = sized(docs, slots, 1 + docs.count() // (slots * CELL_ROWS))
    cells = stored(rows.groupBy("vslot", "cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "slot-sizes")
    version = edited_map(spark, map_path, slot_sizes(cells), n_shards, slots)
    return placed(rows, load_map(spark, map_path, version), cells).select("doc_id", "size", "text_crc32", "vslot", "shard", "slot")
