"""Exact deduplication of a growing collection with static filters per immutable snapshot.

Texts are equal when they are identical after every run of ASCII white space
becomes one space.  The collection is an immutable snapshot, a table of
digests in buckets with one binary fuse filter per bucket, and a new batch:

1. the batch's own duplicates are grouped by digest first, so a hot text
   reaches the filter once;
2. each new digest is screened by the filter of its bucket; most new texts
   stop there;
3. positives join the exact snapshot buckets;
4. members of every group of two or more have their normalised bytes
   compared; a digest shared by different texts is an error.

Of equal texts the row with the smallest ``doc_id`` stays (rows that repeat
that ``doc_id`` with the same text stay with it).  A null text is empty.  A
null ``doc_id`` is never kept unless its whole group has none, and then
``keep_id`` is null.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewise.llm import fuse
from tapewise.llm.common import BLANK, by_value, materialize, text_or_empty

BUCKET_KEYS = 100_000

FILTER_SCHEMA = "bucket int, seed int, length int, segments int, cells binary"


def normalised(col="text") -> Column:
    return F.regexp_replace(text_or_empty(col), BLANK, " ")


def _keys(shas: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(s)[:8] for s in shas), ">u8").astype(np.uint64)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    seed, length, count, cells = fuse.build(_keys(pdf["sha"]))
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "length": [length], "segments": [count], "cells": [cells]})


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if batch.empty:
        return batch.assign(maybe=pd.Series(dtype=bool))[["sha", "first_id", "n", "maybe"]]
    maybe = np.zeros(len(batch), bool)
    for f in filters.itertuples():
        maybe |= fuse.probe(_keys(batch["sha"]), f.seed, f.length, f.segments, f.cells)
    return batch.assign(maybe=maybe)[["sha", "first_id", "n", "maybe"]]


def build_snapshot(digests: DataFrame, bucket_keys: int = BUCKET_KEYS, batch_rows: int = 0) -> tuple[DataFrame, DataFrame, int]:
    """Immutable snapshot of (doc_id, sha): its digest table, its filters and its number of buckets.

    A batch of ``batch_rows`` rows spreads over enough buckets too, however small the snapshot is.
    """
    groups = digests.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups, "snapshot")
    buckets = max(1, -(-max(groups.count(), batch_rows) // bucket_keys))
    filters = groups.select("sha", bucket_of(buckets)).groupBy("bucket").applyInPandas(_build, FILTER_SCHEMA)
    return groups, materialize(filters, "snapshot-filters"), buckets


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("sha"), F.lit(buckets)).cast("int").alias("bucket")


def screen(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Add ``maybe`` to a batch's (sha, first_id, n): whether the snapshot's filter lets the digest through."""
    dealt = batch.select(bucket_of(buckets), "sha", "first_id", "n").groupBy("bucket")
    return dealt.cogroup(filters.groupBy("bucket")).applyInPandas(_screen, "sha binary, first_id long, n long, maybe boolean")


def dedup_groups(digests: DataFrame, in_snapshot: Column, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """(sha, keep_id, group_size) over a snapshot and the batch of all other rows."""
    fresh = digests.filter(~F.coalesce(in_snapshot, F.lit(False)))
    snapshot, filters, buckets = build_snapshot(digests.filter(in_snapshot), bucket_keys, fresh.count())
    batch = fresh.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    screened = materialize(screen(batch, filters, buckets), "screened")
    hits = screened.filter("maybe").select("sha", F.col("first_id").alias("b_first"), F.col("n").alias("b_n"))
    old = snapshot.join(hits, "sha", "left").select(
        "sha", F.least("first_id", "b_first").alias("keep_id"), (F.col("n") + F.coalesce("b_n", F.lit(0))).alias("group_size"))
    new = screened.filter("not maybe").unionByName(
        screened.filter("maybe").join(snapshot.select("sha"), "sha", "left_anti").select(screened.columns))
    return old.unionByName(new.select("sha", F.col("first_id").alias("keep_id"), F.col("n").alias("group_size")))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The lower half of the ids is the snapshot, the rest the incoming batch.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    sha = F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")
    digests = materialize(rows.select("doc_id", sha), "digests")
    middle = digests.agg(F.percentile_approx("doc_id", 0.5, 1000)).first()[0]
    groups = materialize(dedup_groups(digests, F.col("doc_id") <= F.lit(middle if middle is not None else 0)), "dedup-groups")
    several = groups.filter("group_size > 1").select("sha")
    compared = (rows.select(sha, "norm").join(several, "sha").groupBy("sha")
                .agg((F.min("norm") == F.max("norm")).alias("same")))
    checked = groups.join(compared, "sha", "left").select(
        "sha", "keep_id", F.when(F.coalesce("same", F.lit(True)), F.col("group_size"))
        .otherwise(F.raise_error(F.lit("different texts share a digest"))).alias("group_size"))
    return digests.join(checked, "sha").select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


by_value(__name__)
