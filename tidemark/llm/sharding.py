"""Shards of near-equal size that never separate equal groups.

Groups lie in the order of their hash. Hash ranges are the atomic sizes of a minimax
contiguous partition: the smallest shard capacity for which a greedy fill needs no
more shards than wanted is found by binary search, and the order is cut there.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import apart

BUCKET_BITS = 16   # 65,536 atomic sizes at most come to the driver
CHUNKS = 256       # parts of a shard in which slots are counted apart

ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shards_needed(ends: Sequence[int], capacity: int) -> int:
    """Shards of a greedy fill; `ends` are prefix sums of sizes none above `capacity`."""
    shards, filled, at = 0, 0, 0
    while at < len(ends) and ends[-1] > filled:
        at = bisect_right(ends, filled + capacity, at)
        filled = ends[at - 1]
        shards += 1
    return shards


def minimax_capacity(sizes: Sequence[int], shards: int) -> int:
    """The smallest capacity at which `shards` contiguous shards hold all sizes."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if shards_needed(ends, middle) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(sizes: Sequence[int], shards: int) -> list[int]:
    """Ends (excluded) of the shards but the last.

    No shard exceeds the minimax capacity. Within that bound each cut lies as near as
    possible to an equal share of what is left, so that late shards aren't starved.
    """
    capacity = minimax_capacity(sizes, shards)
    starts = [0, *accumulate(sizes)]  # starts[i]: bytes before atom i
    total, n = starts[-1], len(sizes)
    cuts, at = [], 0
    # earliest[k]: the first atom from which k shards of the capacity hold the rest
    earliest = [n]
    for _ in range(shards):
        earliest.append(bisect_left(starts, starts[earliest[-1]] - capacity))
    for left in range(shards, 1, -1):
        most = bisect_right(starts, starts[at] + capacity) - 1
        wish = starts[at] + (total - starts[at]) / left
        best = bisect_left(starts, wish)
        if best > at and wish - starts[best - 1] < starts[min(best, n)] - wish:
            best -= 1
        at = min(max(best, earliest[left - 1], at), most)
        cuts.append(at)
    return cuts


def _cut_by(bucket: Column, cuts: Sequence[int]) -> Column:
    steps = [F.when(bucket >= cut, 1).otherwise(0) for cut in cuts]
    return reduce(lambda a, b: a + b, steps, F.lit(0)).cast("int")


def assign_shards(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = 16
) -> DataFrame:
    """Add `size`, `text_crc32`, `law` ("bytes"), `shard`, `slot` and `grown_shard` (null).

    Sizes are UTF-8 bytes plus 1 (null text: 0 bytes, like empty text). Equal texts
    share a shard. Slots count the rows of a shard without gaps from 0, in the order of
    chunks by hash and of ids inside; rows equal in id and text keep any order. An empty
    table gives no rows. Input columns named like an added one are replaced.

    The sizes of hash ranges (65,536 at most) come from an aggregate with a map-side
    half; the cuts are literals in the plan, so rows find their shard without a shuffle.
    Slots come from windows over hash chunks, each a 256th of a shard, whose offsets are
    one broadcast table of 4,096 rows (256 per shard). No window holds a whole shard or
    a whole group of copies.
    """
    docs, (text, doc_id), kept = apart(docs, ADDED, text, doc_id)
    whole = F.coalesce(F.col(text), F.lit(""))
    hashed = F.xxhash64(whole)
    sized = docs.withColumns(
        {
            "size": (F.octet_length(whole) + 1).cast("long"),
            "_tm_bucket": F.shiftrightunsigned(hashed, 64 - BUCKET_BITS).cast("int"),
            "_tm_chunk": F.pmod(F.xxhash64(F.col(doc_id), hashed), F.lit(CHUNKS)).cast("int"),
        }
    )
    found = sized.groupBy("_tm_bucket").agg(F.sum("size").alias("bytes")).collect()
    sizes = [0] * (1 << BUCKET_BITS)
    for row in found:
        sizes[row["_tm_bucket"]] = row["bytes"]
    placed = sized.withColumn("shard", _cut_by(F.col("_tm_bucket"), minimax_cuts(sizes, shards)))

    before = Window.partitionBy("shard").orderBy("_tm_chunk")
    offsets = (
        placed.groupBy("shard", "_tm_chunk")
        .agg(F.count(F.lit(1)).alias("_tm_rows"))
        .select("shard", "_tm_chunk", (F.sum("_tm_rows").over(before) - F.col("_tm_rows")).alias("_tm_offset"))
    )
    inside = Window.partitionBy("shard", "_tm_chunk").orderBy(F.col(doc_id), "_tm_hash")
    return (
        placed.withColumns({"text_crc32": F.crc32(whole.cast("binary")), "_tm_hash": hashed})
        .withColumn("_tm_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), ["shard", "_tm_chunk"])
        .select(
            *kept,
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_tm_offset") + F.col("_tm_place") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
