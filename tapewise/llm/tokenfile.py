"""Token-id files: Parquet with a list column of ids, readable by column, row group and page.

Documents are range-partitioned and sorted by id, encoded once, and written
as ``(part, part_start, doc_id, n_tokens, ids)``:

- ``ids`` is a list of 32-bit integers with dictionary encoding (a vocabulary
  fits one dictionary page), the ascending metadata columns use delta
  encoding (Parquet format version 2, no dictionary);
- row groups and pages have the stated sizes, and the column and offset
  indexes that the writer adds let a reader fetch some documents' ids, or the
  metadata alone.

Nulls: a null text is empty, a null ``doc_id`` sorts first.  Repeated rows
stay, each with its own ids.  An empty table gives an empty file set.  Other
columns are not stored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, freed, text_or_empty
from tapewise.llm.textids import encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
#: Texts encoded before a batch of ids is handed on.
CHUNK_BYTES = 4 << 20


def _encode(batches, tokenizer: str, end_id: int):
    enc, part, done = encoder(tokenizer), TaskContext.get().partitionId(), 0
    end = np.array([end_id], "<u4").tobytes()

    def pack(keys, found):
        nonlocal done
        counts = np.array([len(x) // 4 for x in found], "int64")
        starts = done + np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
        done += int(counts.sum())
        values = pa.array(np.frombuffer(b"".join(found), "<i4"))
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype("int32"))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), part, "int32")), pa.array(starts), pa.array(keys, pa.int64()), pa.array(counts.astype("int64")),
             pa.ListArray.from_arrays(offsets, values)], names=["part", "part_start", "doc_id", "n_tokens", "ids"])

    keys, found, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = enc.encode(text.as_py()) + end
            keys.append(key)
            found.append(ids)
            size += len(ids)
            if size >= CHUNK_BYTES:
                yield pack(keys, found)
                keys, found, size = [], [], 0
    if found:
        yield pack(keys, found)
    keys = found = None
    freed(None)


def write_token_file(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                     row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Encode every text of ``docs`` (doc_id, text), append ``end_id`` and write the ids in ascending doc_id order."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text"))
    found = rows.drop("tie").mapInArrow(lambda b: _encode(b, tokenizer, end_id),
                            "part int, part_start long, doc_id long, n_tokens long, ids array<int>")
    options = {"compression": "snappy", "parquet.writer.version": "v2", "parquet.block.size": row_group_bytes,
               "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows, "parquet.enable.dictionary": "true"}
    for name in ("part_start", "doc_id", "n_tokens"):
        options[f"parquet.enable.dictionary#{name}"] = "false"
    found.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def _checksums(batches):
    for batch in batches:
        ids = batch.column(batch.num_columns - 1)
        values, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())],
                                         names=[*batch.schema.names[:-1], "ids_crc32"])


def _part_offsets(stored: DataFrame) -> DataFrame:
    """Ids before each part, from the metadata columns alone: one row per written part."""
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return totals.select("part", before.cast("long").alias("before"))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a token file; unread columns are pruned from the scan."""
    schema = "part int, part_start long, doc_id long, n_tokens long, ids array<int>"
    stored = spark.read.schema(schema).parquet(path)
    # one row per part file of the set, so the broadcast side is bounded by the number of write tasks
    return (stored.join(F.broadcast(_part_offsets(stored)), "part")
            .select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids"))


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start, n_tokens and the unsigned crc32 of its ids as read back."""
    return read_token_file(spark, path).mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


by_value(__name__)
