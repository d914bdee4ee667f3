"""Sequence packing: first-fit decreasing on a tournament tree of bin capacities, in random groups of documents.

Each document's ids (with the end id) are cut at multiples of the sequence
length; only the remainder needs a partner.  Documents are dealt at random
into groups of about ``GROUP_DOCS``; inside a group the remainders, longest
first, go to the first sequence with room, found by descending a tournament
tree whose nodes hold the largest free capacity below them.

A sequence that still has more than ``max_pad`` free places is dissolved and
its remainders are cut at powers of two.  Such pieces, longest first, fill
sequences without gaps; the last sequence of a group is emitted as sequences
whose lengths are powers of two, which need no padding.

Nulls: a null text is empty and yields the end id alone; a null ``doc_id`` is
carried.  Repeated rows are packed once each.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, scratch, text_or_empty, tidied
from tapewise.llm.textids import encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
SEQUENCE = 2048
GROUP_DOCS = 8192
MAX_PAD = 8

DOC_SCHEMA = "doc_id long, doc_tokens long, full array<long>, rest long, cuts array<long>"
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                "sequence_tokens long")


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _measure(batches, tokenizer: str, end_id: int, size: int):
    """Per document: its length, the crc32 of each full piece, of the remainder, and of the remainder's power-of-two cuts."""
    enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "doc_tokens", "full", "rest", "cuts"]
    for batch in batches:
        n, full, rest, cuts = [], [], [], []
        for text in batch.column(1):
            ids = memoryview(enc.encode(text.as_py()) + end)
            count = len(ids) // 4
            k, left = divmod(count, size)
            n.append(count)
            full.append([zlib.crc32(ids[4 * size * i:4 * size * (i + 1)]) for i in range(k)])
            rest.append(zlib.crc32(ids[4 * size * k:]) if left else 0)
            at, parts = 4 * size * k, []
            for p in powers(left):
                parts.append(zlib.crc32(ids[at:at + 4 * p]))
                at += 4 * p
            cuts.append(parts)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(full, kind),
                                          pa.array(rest, pa.int64()), pa.array(cuts, kind)], names=names)


class FirstFit:
    """Bins of one capacity; a tournament tree finds the first bin with enough room in logarithmic time."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.used = capacity, 0
        self.leaves = 1 << max(0, (most - 1).bit_length())
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of an item."""
        tree, node = self.tree, 1
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        offset = self.capacity - tree[node]
        tree[node] -= size
        number = node - self.leaves
        self.used = max(self.used, number + 1)
        node >>= 1
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
        return number, offset

    def free(self, number: int) -> int:
        return self.tree[self.leaves + number]


def pack_group(pdf: pd.DataFrame, size: int, max_pad: int) -> pd.DataFrame:
    """Sequences of one group of documents; sequence numbers are local to the group."""
    out, next_id = [], 0
    ids, counts = pdf["doc_id"].to_numpy(object), pdf["doc_tokens"].to_numpy()
    for doc, count, full in zip(ids, counts, pdf["full"]):
        for i, crc in enumerate(full):
            out.append((doc, i * size, size, crc, count, next_id, 0, size))
            next_id += 1
    lefts = counts % size
    order = [int(i) for i in np.argsort(-lefts, kind="stable") if lefts[i]]
    bins = FirstFit(size, max(1, len(order)))
    placed = [(i, *bins.place(int(lefts[i]))) for i in order]
    keep = {b for b in range(bins.used) if bins.free(b) <= max_pad}
    name = {b: next_id + k for k, b in enumerate(sorted(keep))}
    next_id += len(keep)
    pieces = []
    rest, cuts = pdf["rest"].to_numpy(), pdf["cuts"].to_numpy()
    for i, b, offset in placed:
        at, left = int(counts[i] - lefts[i]), int(lefts[i])
        if b in keep:
            out.append((ids[i], at, left, int(rest[i]), counts[i], name[b], offset, size - bins.free(b)))
            continue
        for p, crc in zip(powers(left), cuts[i]):
            pieces.append((p, ids[i], at, int(crc), counts[i]))
            at += p
    pieces.sort(key=lambda x: -x[0])
    total, begun, room, offset = sum(x[0] for x in pieces), 0, 0, 0
    for p, doc, at, crc, count in pieces:
        if offset == room:  # sequences are full lengths first, then falling powers of two
            room, offset = min(size, 1 << (total - begun).bit_length() - 1), 0
            next_id += 1
        out.append((doc, at, p, crc, count, next_id - 1, offset, room))
        offset += p
        begun += p
    names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
    return pd.DataFrame(out, columns=names)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, size: int = SEQUENCE,
         group_docs: int = GROUP_DOCS, max_pad: int = MAX_PAD) -> DataFrame:
    """One row per piece: where each document's ids lie in the packed sequences.

    ``size`` must be a power of two.  Lengths and checksums are written once to
    the shared folder; a row's group comes from its place in those files, so a
    retried task deals the same rows to the same group and equal rows spread.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    spark = docs.sparkSession
    path = scratch(spark, "packing")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
     .mapInArrow(lambda b: tidied(_measure(b, tokenizer, end_id, size)), DOC_SCHEMA).write.parquet(path))
    measured = spark.read.schema(DOC_SCHEMA).parquet(path)
    groups = max(1, -(-measured.count() // group_docs))
    dealt = measured.withColumn("pack_group", F.pmod(F.xxhash64("_metadata.file_name", "_metadata.row_index"), F.lit(groups)))

    def one(key, pdf):
        found = pack_group(pdf, size, max_pad)
        found["sequence_id"] += int(key[0]) << 32
        return found

    return dealt.groupBy("pack_group").applyInPandas(one, PIECE_SCHEMA)


by_value(__name__)
