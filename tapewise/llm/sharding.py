"""Fixed-capacity shards by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form a group that may not be divided.  Groups,
largest first, enter the bin whose free room is the tightest that holds them;
a balanced tree ordered by free room finds it in logarithmic time.

Groups of one size are interchangeable, so the packing reads a histogram: how
many groups each size has.  After a group entered the tightest bin, that bin
is still the tightest for the next group of this size until it is full, so
equal sizes are placed a bin at a time, exactly as one by one.  ``total`` bytes
hold at most ``sqrt(2 * total)`` different sizes, which bounds the histogram
(14 million sizes at 100 TB); groups themselves never leave the executors.
They are numbered within their size, and their number gives the bin.

``slot`` numbers a shard's documents from 0 without gaps.  It comes from block
counts of a table written once, so no task or window holds a whole shard.

Nulls: a null text is an empty one (size 1); a null ``doc_id`` is carried.
Repeated rows are placed one by one, all in the shard of their group.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewise.llm.common import materialize, text_or_empty

SHARDS = 16
BLOCK_ROWS = 1 << 16
#: A text on one of this many rows or a larger share of them is placed by a broadcast table of at most so many rows.
HOT_SHARE = 4096
#: The placements are sent to every task up to this many rows; beyond that the join is shuffled.
BROADCAST_RUNS = 1_000_000
#: Shares by which the capacity may exceed an equal split, tried in this order.
SLACK = (0.0001, 0.0005, 0.002, 0.01, 0.05, 0.25, 1.0)


class RoomTree:
    """A treap of (room, bin): expected logarithmic insert, remove and search for the tightest fit."""

    def __init__(self, seed: int = 7):
        self.root, self.random = None, random.Random(seed)

    def insert(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.random.random(), None, None]), right)

    def take(self, room: int) -> tuple[int, int] | None:
        """Remove and return the entry with the least room that is at least ``room``."""
        left, right = self._split(self.root, (room, -1))
        if right is None:
            self.root = left
            return None
        path, node = None, right
        while node[2] is not None:
            path, node = node, node[2]
        if path is None:
            right = node[3]
        else:
            path[2] = node[3]
        self.root = self._merge(left, right)
        return node[0]

    def _split(self, node, key):
        """Entries below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            a, b = self._split(node[3], key)
            node[3] = a
            return node, b
        a, b = self._split(node[2], key)
        node[2] = b
        return a, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b


def best_fit_runs(histogram: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """(size, first, after, bin): where the ``first``-th up to the ``after``-th item of each size goes, for (size, count) pairs.

    None if an item exceeds the capacity or more than ``most`` bins would be needed.
    """
    rooms, bins, out = RoomTree(), 0, []
    for size, count in sorted(histogram, reverse=True):
        if size > capacity:
            return None
        placed = 0
        while placed < count:
            found = rooms.take(size)
            if found is None:
                if bins == most:
                    return None
                found, bins = (capacity, bins), bins + 1
            n = min(count - placed, found[0] // size)
            out.append((size, placed, placed + n, found[1]))
            rooms.insert((found[0] - n * size, found[1]))
            placed += n
    return out


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item; items of one size in their order."""
    runs = best_fit_runs(list(Counter(sizes).items()), capacity, most)
    if runs is None:
        return None
    bins = defaultdict(list)
    for size, first, after, k in runs:
        bins[size] += [k] * (after - first)
    places = {size: iter(ks) for size, ks in bins.items()}
    return [next(places[size]) for size in sizes]


def fit_shards(histogram: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs of the smallest tried capacity at which best-fit decreasing needs at most ``shards`` bins."""
    total, largest = sum(s * n for s, n in histogram), max((s for s, _ in histogram), default=0)
    for slack in SLACK:
        found = best_fit_runs(histogram, max(largest, -(-total // shards) + int(total / shards * slack)), shards)
        if found is not None:
            return found
    # best-fit decreasing never leaves two bins half empty, so twice the share always fits
    return best_fit_runs(histogram, max(largest, 2 * -(-total // shards) + 1), shards)


def number_rows(df: DataFrame, by: str, name: str) -> DataFrame:
    """Number the rows of each ``by`` value from 0, without gaps; ``df`` must be read from files."""
    block = F.struct(F.col("_metadata.file_name").alias("f"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS).alias("b"))
    rows = df.select("*", block.alias("__block"), F.col("_metadata.row_index").alias("__row"))
    counts = rows.groupBy(by, "__block").agg(F.count(F.lit(1)).alias("__n"))
    run = Window.partitionBy(by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(by, "__block", F.coalesce(F.sum("__n").over(run), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(by, "__block").orderBy("__row")) - 1
    return (rows.join(before, [by, "__block"]).withColumn(name, (F.col("__before") + own).cast("long"))
            .drop("__block", "__row", "__before"))


def place_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(digest, shard) of the stored groups (digest, bytes, n)."""
    sizes = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("groups")).toArrow()
    runs = fit_shards(list(zip(sizes.column("bytes").to_pylist(), sizes.column("groups").to_pylist())), shards)
    runs_table = groups.sparkSession.createDataFrame(runs, "r_bytes long, first long, after long, shard int")
    if len(runs) <= BROADCAST_RUNS:
        runs_table = F.broadcast(runs_table)
    ranked = number_rows(groups, "bytes", "rank")
    here = (F.col("bytes") == F.col("r_bytes")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after"))
    return ranked.join(runs_table, here).select("digest", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; shards are nearly equal in bytes."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    placed = materialize(place_groups(groups, shards), "shard-placed")
    # a hot text's rows meet its shard without a shuffle; there are at most HOT_SHARE such texts
    count = groups.agg(F.sum("n")).first()[0] or 0
    hot = groups.filter(F.col("n") * HOT_SHARE >= F.lit(count)).filter("n > 1").select("digest")
    hot = placed.join(F.broadcast(hot), "digest", "left_semi").select("digest", F.col("shard").alias("hot_shard"))
    rows = rows.join(F.broadcast(hot), "digest", "left")
    # their keys in the shuffle are spread, and match no digest
    key = F.when(F.col("hot_shard").isNull(), F.col("digest")).otherwise(F.monotonically_increasing_id().cast("string").cast("binary"))
    found = rows.withColumn("key", key).join(placed.withColumnRenamed("digest", "key"), "key", "left").select(
        "doc_id", "size", "text_crc32", F.coalesce("hot_shard", "shard").alias("shard"))
    return number_rows(materialize(found, "shards"), "shard", "slot")
