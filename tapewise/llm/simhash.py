"""SimHash fingerprints joined by Hamming distance through a Gray-order hierarchical index.

A text's fingerprint has a bit set where over half of the XXH64 values of its
word shingles, repeats included, have it.  Equal fingerprints are one entry, so
thousands of copies weigh as much as one.

1. *Order.*  Entries are range-partitioned and sorted by Gray rank (the place of
   a fingerprint in the reflected Gray sequence), which puts entries that share
   bit patterns side by side, and cut into blocks of ``BLOCK``.
2. *Upper nodes.*  ``FANOUT`` neighbouring blocks, and so on up, share a node that
   factors out the bits all of them agree on: a mask and the masked pattern.
   Pairs of nodes are followed down level by level; a pair whose patterns differ
   in more than ``DISTANCE`` of the bits fixed in both is dropped with all below.
3. *Blocks.*  Each surviving pair of blocks meets in one task.  Its entries form
   the lower levels of the same index, walked in the same way down to single
   entries, where all bits are fixed and the accumulated difference is exact.
4. Only links that join groups leave a task, so a dense group of near copies gives
   rows by its size.  Components follow from all links.

Texts without words have fingerprint zero and link like any other; fewer words
than a shingle form one shingle.  Nulls count as empty.  Rows that repeat are
rows of their own; a null ``doc_id`` is never a component's least id unless all
of its ids are null.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, materialize, text_or_empty, tidied
from tapewise.llm.components import components

WIDTH = 3
DISTANCE = 3
SEED = 42
BLOCK = 8192
FANOUT = 8
#: Shingles counted and pairs of nodes compared at once.
SLAB = 1 << 16
U = np.uint64
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(256)).lower()  # changes A-Z only


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint of a whole text in UTF-8."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[min(width, len(words)) - 1:]
    first = np.concatenate(([0], ends[:-1] + 1))[:len(last)]
    counts, digest = np.zeros(64, "int64"), xxhash.xxh64_intdigest
    for at in range(0, len(last), SLAB):
        spans = zip(first[at:at + SLAB].tolist(), last[at:at + SLAB].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(last), bitorder="little").view("<u8")[0])


def _fingerprints(batches, width: int):
    for batch in batches:
        found = [fingerprint(x.as_buffer().to_pybytes(), width) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, U).view("i8"))], names=["doc_id", "fp"])


def gray_rank(fp: Column) -> Column:
    """Place of the fingerprint in the reflected Gray sequence, as a signed long of the same order."""
    rank = fp
    for k in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, k))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def factored(fixed: np.ndarray, pattern: np.ndarray, fanout: int = FANOUT) -> tuple[np.ndarray, np.ndarray]:
    """Nodes over each ``fanout`` neighbours: the bits fixed alike in all of them, and their values."""
    at = np.arange(0, len(fixed), fanout)
    ones = np.bitwise_and.reduceat(pattern | ~fixed, at)
    some = np.bitwise_or.reduceat(pattern, at)
    shared = np.bitwise_and.reduceat(fixed, at) & ~(some & ~ones)
    return shared, some & shared


def _blocks(frames):
    """Blocks of a partition's entries, which come sorted: partition, place, mask, pattern and the entries."""
    left, part, done = np.zeros(0, U), TaskContext.get().partitionId(), 0
    for pdf in frames:
        left = np.concatenate((left, pdf["fp"].to_numpy("int64").view(U)))
        whole = len(left) // BLOCK * BLOCK
        if whole:
            yield _cut(left[:whole], part, done)
            left, done = left[whole:], done + whole // BLOCK
    if len(left):
        yield _cut(left, part, done)


def _cut(entries: np.ndarray, part: int, done: int) -> pd.DataFrame:
    fixed, pattern = factored(np.full(len(entries), ~U(0)), entries, BLOCK)
    parts = [entries[i:i + BLOCK].astype("<u8").tobytes() for i in range(0, len(entries), BLOCK)]
    return pd.DataFrame({"part": part, "place": done + np.arange(len(parts)), "fixed": fixed.view("i8"), "pattern": pattern.view("i8"),
                         "entries": parts})


def _levels(entries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    levels = [(np.full(len(entries), ~U(0)), entries)]
    while len(levels[-1][0]) > 1:
        levels.append(factored(*levels[-1]))
    return levels


def close_pairs(a: np.ndarray, b: np.ndarray, distance: int = DISTANCE):
    """Arrays (i, j) of entries of two sorted blocks that differ in ``distance`` bits or fewer, walked down both indexes."""
    up_a, up_b = _levels(a), _levels(b)
    height = max(len(up_a), len(up_b))
    for up in (up_a, up_b):
        up += [up[-1]] * (height - len(up))  # a single node stands for itself
    step = np.arange(FANOUT)
    todo = [(height - 1, np.zeros(1, "int64"), np.zeros(1, "int64"))]
    while todo:
        level, i, j = todo.pop()
        (fixed_a, pattern_a), (fixed_b, pattern_b) = up_a[level], up_b[level]
        apart = np.bitwise_count((pattern_a[i] ^ pattern_b[j]) & fixed_a[i] & fixed_b[j])
        i, j = i[apart <= distance], j[apart <= distance]
        if level == 0:
            yield i, j
            continue
        n, m = len(up_a[level - 1][0]), len(up_b[level - 1][0])
        for at in range(0, len(i), SLAB // FANOUT):
            x, y = (k[at:at + SLAB // FANOUT, None] * FANOUT + step for k in (i, j))
            x, y = np.repeat(x, FANOUT, axis=1).ravel(), np.tile(y, FANOUT).ravel()
            real = (x < n) & (y < m)
            todo.append((level - 1, x[real], y[real]))


class Groups:
    """Groups of the numbers 0 to n - 1, joined by links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            x = up

    def join(self, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
        """Join along all links; those that were needed."""
        self.parent = self.roots(self.parent)
        rx, ry = self.parent[x], self.parent[y]
        apart = np.flatnonzero(rx != ry)
        if not len(apart):
            return []
        keys = np.minimum(rx, ry)[apart] * len(self.parent) + np.maximum(rx, ry)[apart]
        apart, used = apart[np.unique(keys, return_index=True)[1]], []
        for k in apart.tolist():
            p, q = (int(self.roots(np.array([r[k]]))[0]) for r in (rx, ry))
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                used.append((int(x[k]), int(y[k])))
        return used


def _links(pdf: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Links between groups of two blocks (or inside one): a pair's two rows meet here."""
    parts = [np.frombuffer(x, "<u8").astype(U) for x in pdf.sort_values("side")["entries"]]
    a, b = parts[0], parts[-1]
    one = len(parts) == 1
    groups, out, entries = Groups(len(a) if one else len(a) + len(b)), [], a if one else np.concatenate((a, b))
    for i, j in close_pairs(a, b, distance):
        out += groups.join(i[i < j], j[i < j]) if one else groups.join(i, j + len(a))
    out = np.array(out, "int64").reshape(-1, 2)
    return pd.DataFrame({"a": entries[out[:, 0]].view("i8"), "b": entries[out[:, 1]].view("i8")})


def block_pairs(blocks: DataFrame, distance: int = DISTANCE, fanout: int = FANOUT) -> DataFrame:
    """Pairs (a <= b) of blocks (block, fixed, pattern) that can hold a link, found from the root of the upper nodes down."""
    levels, count = [blocks.select(F.col("block").alias("node"), "fixed", "pattern")], blocks.count()
    while count > 1:
        below = levels[-1].withColumn("up", F.floor(F.col("node") / fanout).cast("long"))
        ones, some = F.bit_and(F.col("pattern").bitwiseOR(F.bitwise_not("fixed"))), F.bit_or("pattern")
        up = below.groupBy("up").agg(F.bit_and("fixed").alias("f"), ones.alias("ones"), some.alias("some"))
        fixed = F.col("f").bitwiseAND(F.bitwise_not(F.col("some").bitwiseAND(F.bitwise_not("ones"))))
        levels.append(materialize(up.select(F.col("up").alias("node"), fixed.alias("fixed"), F.col("some").bitwiseAND(fixed).alias("pattern")),
                                  "simhash-nodes"))
        count = -(-count // fanout)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for nodes in reversed(levels[:-1]):
        kids = [nodes.select(F.floor(F.col("node") / fanout).cast("long").alias(up), F.col("node").alias(f"node_{up}"),
                             F.col("fixed").alias(f"fixed_{up}"), F.col("pattern").alias(f"pattern_{up}")) for up in ("a", "b")]
        both = pairs.join(kids[0], "a").join(kids[1], "b").filter("node_a <= node_b")
        apart = F.bit_count(F.col("pattern_a").bitwiseXOR(F.col("pattern_b")).bitwiseAND(F.col("fixed_a")).bitwiseAND(F.col("fixed_b")))
        pairs = both.filter(apart <= distance).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return pairs


def close_links(entries: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct fingerprints ``fp`` within ``distance``."""
    parts = max(1, -(-entries.count() // (4 * BLOCK)))
    ordered = entries.select("fp").repartitionByRange(parts, gray_rank(F.col("fp"))).sortWithinPartitions(gray_rank(F.col("fp")))
    cut = materialize(ordered.mapInPandas(_blocks, "part int, place long, fixed long, pattern long, entries binary"), "simhash-cut")
    # numbered in Gray order: one row per partition goes through the running sum
    counts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = cut.join(counts.select("part", before.alias("before")), "part").withColumn("block", F.col("before") + F.col("place"))
    pairs = materialize(block_pairs(blocks.select("block", "fixed", "pattern"), distance), "simhash-pairs")
    sides = pairs.withColumn("side", F.lit(0)).withColumn("block", F.col("a")).unionByName(
        pairs.filter("a < b").withColumn("side", F.lit(1)).withColumn("block", F.col("b")))
    met = sides.join(blocks.select("block", "entries"), "block").select("a", "b", "side", "entries")
    found = met.groupBy("a", "b").applyInPandas(lambda pdf: _links(pdf, distance), "a long, b long")
    return materialize(found, "simhash-links")


def simhash_components(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    prints = materialize(rows.mapInArrow(lambda b: tidied(_fingerprints(b, width)), "doc_id long, fp long"), "simhash-prints")
    entries = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-entries")
    found = components(close_links(entries, distance))
    grouped = entries.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(grouped.join(least, "component").select("fp", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


by_value(__name__)
