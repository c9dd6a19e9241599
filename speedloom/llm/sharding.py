"""Sharding (8): byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together. Groups are dealt into blocks of about BLOCK by a hash. In a block, every
group starts as a partial partition (its bytes in one part, nothing in the others); the two with the largest spread are
combined, the largest part of one with the smallest of the other, until one is left. The partial partitions of the blocks are combined in the
same way, level by level, so that no task sees more than a few blocks' worth of groups and the number of blocks grows with the input.

Null text counts as empty. Repeated rows are members of their group. An empty table gives an empty result. A group larger than the mean
shard cannot be split and makes its shard larger. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from speedloom.llm.common import stage, whole_groups

SHARDS = 40
#: Groups, or partial partitions, that one task combines at a time, on average.
BLOCK = 4096
#: Bytes that a document counts besides its text.
OVERHEAD = 16
#: Rows of a shard that are numbered together, on average.
NUMBERED = 5000


def combined(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Part that each part of each partial partition (row) goes to, and the bytes of the parts, the largest first."""
    k = start.shape[1]
    order = np.argsort(-start, axis=1, kind="stable")
    sums = list(np.take_along_axis(start, order, axis=1))
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        by = np.argsort(-both, kind="stable")
        made.append((a, b, by))
        sums.append(both[by])
        heapq.heappush(heap, (-int(sums[-1][0] - sums[-1][-1]), len(sums) - 1))
    place = np.empty((len(sums), k), np.int64)
    place[-1] = np.arange(k)
    for at in range(len(made) - 1, -1, -1):  # from the last combination back to the first
        a, b, by = made[at]
        place[a, by] = place[len(start) + at]
        place[b, (k - 1) - by] = place[len(start) + at]
    out = np.empty(start.shape, np.int64)
    np.put_along_axis(out, order, place[: len(start)], axis=1)
    return out, sums[-1]


def level(items: DataFrame, blocks: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """item, block, to (parts its parts go to); and block, bytes: the blocks as the items of the next level.

    items: item, bytes (an array with the bytes of each part, or a single one for the first).
    """
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(blocks)), F.lit(blocks)))
    dealt = dealt.repartition("block").sortWithinPartitions("block", "item")

    def rows(batches):
        for whole, starts in whole_groups(batches, ["block"]):
            names = whole.column("block").to_pylist()
            sizes, flat = whole.column("bytes").combine_chunks().value_lengths().to_numpy(), whole.column("bytes").combine_chunks().flatten().to_numpy()
            ends = np.cumsum(sizes)
            for lo, hi in zip(starts, starts[1:]):
                start = np.zeros((hi - lo, shards), np.int64)
                width = int(sizes[lo])
                start[:, :width] = flat[ends[lo] - width : ends[hi - 1]].reshape(hi - lo, width)
                to, total = combined(start)
                yield pa.RecordBatch.from_arrays(
                    [whole.column("item").slice(lo, hi - lo).combine_chunks(), pa.array([names[lo]] * (hi - lo), pa.int64()), pa.array(to[:, :width].tolist(), pa.list_(pa.int64())), pa.array([None] * (hi - lo), pa.list_(pa.int64()))],
                    names=["item", "block", "to", "bytes"],
                )
                yield pa.RecordBatch.from_arrays([pa.array([None], whole.schema.field("item").type), pa.array([names[lo]], pa.int64()), pa.array([None], pa.list_(pa.int64())), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["item", "block", "to", "bytes"])

    kind = dict(items.dtypes)["item"]
    out = stage(dealt.mapInArrow(rows, f"item {kind}, block long, to array<long>, bytes array<long>"), "shard-level")
    return out.where("to is not null").select("item", "block", "to"), out.where("bytes is not null").select(F.col("block").alias("item"), "bytes")


def group_shards(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """key, shard of every group (key, bytes)."""
    items, levels = groups.select(F.col("key").alias("item"), F.array("bytes").alias("bytes")), []
    while True:
        blocks = max(1, -(-items.count() // block))
        moved, items = level(items, blocks, shards)
        levels.append(moved)
        if blocks == 1:
            break
    top = levels.pop().select(F.col("item"), F.col("to").alias("part_to"))
    while levels:
        below = levels.pop()
        above = top.withColumnRenamed("item", "block")
        top = below.join(above, "block").select("item", F.transform("to", lambda p: F.get("part_to", p.cast("int"))).alias("part_to"))
    return top.select(F.col("item").alias("key"), F.col("part_to")[0].cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (its number in the shard) of every document."""
    text = F.coalesce("text", F.lit(""))
    sized = stage(
        docs.select("doc_id", (F.octet_length(text).cast("long") + overhead).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")), "shard-sizes"
    )
    groups = stage(sized.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = sized.join(group_shards(groups, shards), "key").drop("key")
    ranges = max(1, -(-sized.count() // (shards * NUMBERED)))
    placed = stage(placed.withColumn("range", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(ranges)).cast("int")), "shard-placed")
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    counts = counts.select("shard", "range", (F.sum("n").over(W.partitionBy("shard").orderBy("range")) - F.col("n")).alias("before"))
    number = F.row_number().over(W.partitionBy("shard", "range").orderBy("doc_id"))
    return placed.withColumn("number", number).join(counts, ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("number") - 1).cast("long").alias("slot")
    )
