"""Sharding by minimax contiguous partition over ordered groups of equal texts."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.llm.common import unused
from logwarden.operators.durable import durable

SHARDS = 16

#: Hex digits of the group key that the first histogram shows, and that each closer look adds.
FIRST_DIGITS, MORE_DIGITS = 3, 2

#: Rows that one task numbers at a time.
SLOT_ROWS = 20_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the group key: a digest, the same for equal texts and for null and empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("group_key"))


class Histogram:
    """Ordered segments of the key space: first key, size, number of groups."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.rows = sorted(rows)
        self.ends = list(accumulate(r[1] for r in self.rows))
        self.total = self.ends[-1] if self.rows else 0

    def cuts(self, capacity: int, shards: int, up: bool = False) -> list[int]:
        """Greedy cuts as running sizes: each shard takes segments while they fit (``up``: until it is full)."""
        found, at = [], 0
        for _ in range(shards):
            i = bisect_left(self.ends, at + capacity) if up else bisect_right(self.ends, at + capacity) - 1
            at = max(at, self.ends[min(i, len(self.ends) - 1)] if i >= 0 else 0)
            found.append(at)
        return found

    def smallest_capacity(self, shards: int, low: int) -> int:
        """Binary search for the least capacity whose greedy cuts take everything."""
        low, high = max(low, -(-self.total // shards)), max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def unsure(self, low: int, high: int, shards: int) -> list[str]:
        """Segments of several groups in which a cut may lie, whatever capacity from low to high is the least."""
        keys = set()
        for first, last in zip(self.cuts(low, shards), self.cuts(high, shards, up=True)):
            begin, end = bisect_right(self.ends, first), bisect_left(self.ends, last)
            keys.update(k for k, _, groups in self.rows[begin:end + 1] if groups > 1)
        return sorted(keys)


def shard_starts(groups: DataFrame, shards: int) -> list[str]:
    """First keys of shards 1, 2, ... for the smallest largest shard.

    The driver holds a histogram of the key space, never the groups: 4096 segments at first, then
    256 parts of those segments in which a cut may lie, until each of them is one group. Every
    look is one aggregate over the groups table.
    """
    def look(frame: DataFrame, digits: int) -> list[tuple]:
        return [tuple(r) for r in frame.groupBy(F.substring("group_key", 1, digits).alias("k")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"), F.max("size").alias("largest")).collect()]

    rows = look(groups, FIRST_DIGITS)
    if not rows:
        return []
    low = max(r[3] for r in rows)
    segments = {r[0]: r[:3] for r in rows}
    while True:
        histogram = Histogram(list(segments.values()))
        capacity = histogram.smallest_capacity(shards, low)
        unsure = histogram.unsure(max(low, -(-histogram.total // shards)), capacity, shards)
        if not unsure:
            break
        for digits in sorted({len(k) for k in unsure}):
            keys = [k for k in unsure if len(k) == digits]
            closer = groups.where(F.substring("group_key", 1, digits).isin(keys))
            for key in keys:
                del segments[key]
            segments.update({r[0]: r[:3] for r in look(closer, min(64, digits + MORE_DIGITS))})
    ends = even_cuts(histogram, capacity, shards)
    return [histogram.rows[bisect_right(histogram.ends, end)][0] for end in ends if end < histogram.total]


def even_cuts(histogram: Histogram, capacity: int, shards: int) -> list[int]:
    """Cuts within the capacity, as near to equal sizes as it lets them be.

    Plain greedy cuts leave the last shards empty when one group is larger than a fair share. A
    cut may lie anywhere from where the later shards can still take the rest to where the shard
    is full; the one nearest to a fair share of the rest is taken.
    """
    mirror = Histogram([(k, size, n) for k, (_, size, n) in enumerate(reversed(histogram.rows))])
    backward = [histogram.total - e for e in mirror.cuts(capacity, shards)]
    edges, at, found = [0, *histogram.ends], 0, []
    for i in range(shards - 1):
        least = max(at, backward[shards - 2 - i])
        most = edges[bisect_right(edges, at + capacity) - 1]
        fair = at + (histogram.total - at) / (shards - i)
        j = bisect_left(edges, fair)
        near = min(edges[max(0, j - 1):j + 1] or [at], key=lambda e: abs(e - fair))
        at = min(max(near, least), most)
        found.append(at)
    return found


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Groups are equal texts (null counts as empty), ordered by their SHA-256. The smallest feasible
    largest shard is found by binary search with greedy checks; shards are contiguous in the order
    of groups and keep groups whole. Law ``bytes``: sizes are near equal unless one group alone is
    larger than a fair share. Slots run gapless from 0 in every shard, by a hash bucket of doc_id,
    then doc_id. Missing and repeated ids get slots like any others; an empty table gives no rows;
    other columns are ignored.
    """
    rows = durable(sized(docs), "sharding-sizes")
    groups = durable(rows.groupBy("group_key").agg(F.sum("size").alias("size")), "sharding-groups")
    return _placed(rows, shard_starts(groups, shards), F.lit("bytes"))


def _placed(rows: DataFrame, starts: list[str], law: Column) -> DataFrame:
    shard = sum((F.when(F.col("group_key") >= s, 1).otherwise(0) for s in starts), F.lit(0)).cast("int")
    buckets = max(1, rows.count() // (SLOT_ROWS * SHARDS))
    placed = rows.withColumn("shard", shard).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "group_key"))
    return placed.withColumn("number", number).join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", law.alias("law"), "shard",
        (F.col("before") + F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents as one folder per shard, with their own columns and the shard as ``shard``.

    Where the documents have a column ``shard`` of their own, the number gets underscores before its
    name. Null texts count as empty; rows of equal texts lie in one shard; no rows write nothing.
    """
    name = unused(docs, "shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    groups = durable(sized(docs).groupBy("group_key").agg(F.sum("size").alias("size")), "sharding-groups")
    starts = shard_starts(groups, shards)
    shard = sum((F.when(F.sha2(text, 256) >= s, 1).otherwise(0) for s in starts), F.lit(0)).cast("int")
    docs.withColumn(name, shard).write.partitionBy(name).parquet(path)
