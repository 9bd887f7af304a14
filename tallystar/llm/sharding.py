"""Sharding by a minimax contiguous partition, in DataFrame functions only.

Documents of equal text are one atomic group.  The groups stand in order of size, largest first, ties by
hash; a binary search finds the smallest capacity for which filling shards greedily in that order needs
no more shards than there are, and the order is cut there.  A group larger than the mean of what
is left fills a shard of its own before the search, so that one giant group does not set
the capacity of the others.

Equal sizes are interchangeable, so the search needs the histogram of group sizes only: at most
sqrt(2 * bytes) distinct values.  Ranks of groups and slots of documents come from range partitions:
each row's place in its partition plus the number of rows in the partitions before.

Law ``bytes``: the sizes of shards are near equal; counts are not, and one more shard moves rows.

Cases: a null text counts as an empty one (eight bytes, CRC zero, in the group of empty texts); repeated rows
are members of one group with a slot each; fewer groups than shards leave shards empty; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import kept

SHARDS = 24
ROW_BYTES = 8


class Groups:
    """Sizes of ordered groups as runs of equal ones; a position is a number of groups."""

    def __init__(self, runs: list[tuple[int, int]]):
        self.size = [s for s, _ in runs]
        self.first, self.before = [], []
        count = total = 0
        for size, n in runs:
            self.first.append(count)
            self.before.append(total)
            count, total = count + n, total + size * n
        self.count, self.total = count, total

    def sum_before(self, position: int) -> int:
        if position >= self.count:
            return self.total
        run = bisect_right(self.first, position) - 1
        return self.before[run] + (position - self.first[run]) * self.size[run]

    def reach(self, limit: int) -> int:
        """The most groups from the start whose sum is at most ``limit``."""
        if limit >= self.total:
            return self.count
        run = bisect_right(self.before, limit) - 1
        return self.first[run] + (limit - self.before[run]) // self.size[run]

    def fits(self, position: int, shards: int, capacity: int) -> bool:
        """Whether greedy filling from ``position`` needs no more shards."""
        for _ in range(shards):
            if position >= self.count:
                return True
            position = self.reach(self.sum_before(position) + capacity)
        return position >= self.count

    def cuts(self, shards: int) -> list[int]:
        """Where each shard ends, as positions."""
        ends, at = [], 0
        while shards > len(ends) + 1 and at < self.count:
            left = self.total - self.sum_before(at)
            size = self.sum_before(at + 1) - self.sum_before(at)
            if size * (shards - len(ends)) < left:
                break
            at += 1  # a group above the mean of what is left
            ends.append(at)
        rest = shards - len(ends)
        if at < self.count:
            left, largest = self.total - self.sum_before(at), self.sum_before(at + 1) - self.sum_before(at)
            low, high = max(largest, -(-left // rest)), left
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if self.fits(at, rest, middle) else (middle + 1, high)
            for k in range(rest, 0, -1):
                # Up to the mean of what is left where the others still fit, else as far as the capacity goes.
                here = self.sum_before(at)
                mean = self.reach(here + (self.total - here) // k)
                mean += mean < self.count and self.sum_before(mean) < here + -(-(self.total - here) // k)
                most = self.reach(here + low)
                at = mean if mean <= most and self.fits(mean, k - 1, low) else most
                ends.append(at)
        return ends + [self.count] * (shards - len(ends))


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place in the given total order as ``rank``: sorted by range partitions, written once, and
    counted per partition."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = kept(sorted_.withColumn("place__", F.monotonically_increasing_id()), name)
    part = F.shiftright("place__", 33)
    # A row for each partition.
    counts = placed.groupBy(part.alias("part__")).agg(F.count("*").alias("n__"))
    before = F.sum("n__").over(Window.orderBy("part__")) - F.col("n__")
    counts = counts.select("part__", before.alias("before__"))
    within = F.col("place__").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("key__", part)
        .join(F.broadcast(counts), F.col("key__") == F.col("part__"))
        .withColumn("rank", F.col("before__") + within)
        .drop("place__", "key__", "part__", "before__")
    )


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = kept(
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group_key"),
        ),
        "shard-rows",
    )
    groups = kept(rows.groupBy("group_key").agg(F.sum("size").alias("group_size")), "shard-groups")
    histogram = groups.groupBy("group_size").agg(F.count("*").alias("n")).orderBy(F.desc("group_size"))
    ordered = Groups([(r["group_size"], r["n"]) for r in histogram.toLocalIterator()])
    ends = ordered.cuts(shards)
    # The shard of a position is the number of shards that end at or before it.
    shard = sum((F.col("rank") >= end).cast("int") for end in ends[:-1]) if shards > 1 else F.lit(0)
    places = ranked(groups, [F.desc("group_size"), F.col("group_key")], "shard-ranks").select(
        F.col("group_key").alias("key"), shard.alias("shard")
    )
    # Copies by the thousand meet one row here: the join's skewed partitions are split.
    dealt = rows.join(places, rows["group_key"] == places["key"]).select("doc_id", "size", "text_crc32", "shard")
    order = [F.col("shard"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ranks = ranked(dealt, order, "shard-slots")
    first = ranks.groupBy("shard").agg(F.min("rank").alias("first")).withColumnRenamed("shard", "of")
    return ranks.join(F.broadcast(first), F.col("shard") == F.col("of")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
