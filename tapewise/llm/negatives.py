"""Hard-negative mining with Kronecker-packed inner products.

Anchors meet all rows in tiles, a block of anchors by a chunk of rows, each one
task.  Inside a tile the integer components of several rows are shifted to be
non-negative and packed into separated fields of one wide integer; one
multiplication by an anchor's component then advances the scores of all rows in
the word, and the exact scores are unpacked from the fields at the end.  While a
field of the largest possible score fits at least twice into 53 bits, a word is
an integer held by a double, so that the products are a matrix product without
rounding; larger components use Python integers as words.

1. Tiles return each anchor's best rows of its own label; a ranking over the
   tiles leaves its positives.
2. With the positives' scores known, tiles return, for each anchor and positive,
   the best rows of other labels in the score range; a second ranking leaves the
   negatives.

Rows are dealt to chunks at random, so a label or an id that many rows share
does not fill one tile.  A tile holds at most ``ANCHOR_BLOCK`` anchors and about
``MOST_ROWS`` rows; more rows mean more tiles.

Rows with a null id, label or vector or with a null or non-finite component take
no part.  Shorter vectors count as filled up with zeros, empty ones score 0.
Rows that repeat are rows of their own, but an anchor that repeats wholly counts
once, and rows with the anchor's id are never its positives.  Ties go to the
smaller id.  Components of 2**28 and more can give scores beyond a long, which
stop at its limits.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewise.llm.common import by_value, materialize

POSITIVES = 5
NEGATIVES = 10
#: Negatives score from LOW to HIGH percent of the positive's score.
LOW, HIGH = 30, 90
SCALE = 256
ANCHOR_BLOCK = 8192
LEAST_ROWS, MOST_ROWS = 2048, 1 << 17
#: Rows and anchors multiplied at once.
BATCH_ROWS, BATCH_ANCHORS = 2048, 512
EXACT_BITS = 53
WIDE_FIELDS = 16
LONG = (1 << 63) - 1

NEAREST = "anchor long, vec_id long, score long"
HARDEST = "anchor long, place int, vec_id long, score long"


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``width``."""
    out = np.zeros((len(vectors), width), "int64")
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, anchors by rows, through fields of wide integers."""
    n, width = rows.shape
    shift_a, shift_r = (max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (anchors, rows))
    bits = max(1, (width * 4 * shift_a * shift_r).bit_length())
    kind, fields = (np.float64, EXACT_BITS // bits) if 2 * bits <= EXACT_BITS else (object, WIDE_FIELDS)
    whole = "int64" if kind is np.float64 else object
    a, r = anchors.astype(whole), rows.astype(whole)
    words = -(-n // fields)
    shifted = np.zeros((words * fields, width), whole)
    shifted[:n] = r + shift_r
    shifted = shifted.reshape(words, fields, width)
    packed = sum(shifted[:, k] << bits * k for k in range(fields))
    product = ((a + shift_a).astype(kind) @ packed.astype(kind).T).astype(whole)
    scores = np.empty((len(a), words * fields), whole)
    for k in range(fields):
        scores[:, k::fields] = product >> bits * k & (1 << bits) - 1
    # undo the shifts: (a + A)(r + R) = ar + R a + A r + A R
    scores = scores[:, :n] - shift_r * a.sum(1)[:, None] - shift_a * r.sum(1)[None, :] - width * shift_a * shift_r
    return scores if whole == "int64" else np.clip(scores, -LONG, LONG).astype("int64")


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) positions of the ``k`` highest allowed scores of each anchor; the earlier row wins a tie."""
    n = scores.shape[1]
    if n and max(int(scores.max(initial=0)), -int(scores.min(initial=0))) < LONG // (2 * n):
        order = np.where(allowed, scores * n + (n - 1 - np.arange(n)), -LONG)
        top = np.argpartition(order, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), scores.shape)
    else:
        top = np.lexsort((-scores, ~allowed), axis=1)[:, :k]
    at, place = np.nonzero(np.take_along_axis(allowed, top, axis=1))
    return at, top[at, place]


def _batches(anchors: pd.DataFrame, rows: pd.DataFrame):
    """Scores of all anchors and rows of a tile, in batches; each batch has its rows in order of id."""
    width = max((len(v) for x in (anchors, rows) for v in x["vec"]), default=0)
    rows = rows.sort_values("vec_id", kind="stable")
    for i in range(0, len(anchors), BATCH_ANCHORS):
        some = anchors.iloc[i:i + BATCH_ANCHORS]
        a = matrix(some["vec"], width)
        for j in range(0, len(rows), BATCH_ROWS):
            part = rows.iloc[j:j + BATCH_ROWS]
            yield some, part, packed_scores(a, matrix(part["vec"], width))


def _column(df: pd.DataFrame, name: str) -> np.ndarray:
    return df[name].to_numpy("int64")


def _nearest(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The tile's best rows of each anchor's label."""
    out = [pd.DataFrame({"anchor": [], "vec_id": [], "score": []}, dtype="int64")]
    for some, part, scores in _batches(anchors, rows):
        ids = _column(part, "vec_id")
        allowed = (_column(some, "label")[:, None] == _column(part, "label")) & (_column(some, "vec_id")[:, None] != ids)
        at, row = best(scores, allowed, POSITIVES)
        out.append(pd.DataFrame({"anchor": _column(some, "anchor")[at], "vec_id": ids[row], "score": scores[at, row]}))
    return pd.concat(out)


def _hardest(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The tile's best rows of other labels in the range of each anchor's positives."""
    out = [pd.DataFrame({"anchor": [], "place": [], "vec_id": [], "score": []}, dtype="int64")]
    for some, part, scores in _batches(anchors, rows):
        ids, other = _column(part, "vec_id"), _column(some, "label")[:, None] != _column(part, "label")
        found = [[int(x) for x in s] for s in some["scores"]]
        for p in range(max(map(len, found))):
            with_p = np.array([i for i, s in enumerate(found) if len(s) > p])
            low = np.array([-(-LOW * found[i][p] // 100) for i in with_p])
            high = np.array([HIGH * found[i][p] // 100 for i in with_p])
            mine = scores[with_p]
            at, row = best(mine, other[with_p] & (mine >= low[:, None]) & (mine <= high[:, None]), NEGATIVES)
            out.append(pd.DataFrame({"anchor": _column(some, "anchor")[with_p[at]], "place": p + 1, "vec_id": ids[row],
                                     "score": mine[at, row]}))
    return pd.concat(out)


def usable(rows: DataFrame, vec: str = "embedding") -> DataFrame:
    """vec_id, label and integer components of the rows that take part."""
    x = F.transform(F.col(vec), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"), bad.alias("bad"))
    rows = rows.filter("vec_id is not null and label is not null and x is not null and not bad")
    return rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * SCALE)).alias("vec"))


def _tiles(anchors: DataFrame, rows: DataFrame, blocks: int, chunks: int, kernel, schema: str) -> DataFrame:
    tile = ["block", "chunk"]
    left = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = rows.withColumn("chunk", F.floor(F.rand(7) * chunks).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(kernel, schema)


def hard_negatives(rows: DataFrame, is_anchor) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has vec_id, label and vec (integers); ``is_anchor`` is a predicate on it.
    """
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_anchor, 1)).alias("anchors"),
                     F.max(F.array_max(F.transform("vec", F.abs))).alias("largest")).first()
    if (sizes["largest"] or 0) < 1 << 31:
        rows = rows.withColumn("vec", F.col("vec").cast("array<int>"))
    blocks = max(1, -(-sizes["anchors"] // ANCHOR_BLOCK))
    chunks = max(1, -(-sizes["rows"] // min(MOST_ROWS, max(LEAST_ROWS, 8 * isqrt(sizes["rows"])))))
    anchors = materialize(rows.filter(is_anchor).distinct().withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")

    near = _tiles(anchors, rows, blocks, chunks, _nearest, NEAREST)
    by_score = [F.desc("score"), F.col("vec_id")]
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(*by_score))).filter(F.col("place") <= POSITIVES)
    found = F.array_sort(F.collect_list(F.struct("place", "vec_id", "score")))  # at most POSITIVES
    positives = materialize(near.groupBy("anchor").agg(found.alias("found")), "negatives-positives")

    with_scores = anchors.join(positives, "anchor").select("anchor", "vec_id", "label", "vec", F.col("found.score").alias("scores"))
    hard = _tiles(with_scores, rows, blocks, chunks, _hardest, HARDEST)
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*by_score))
    hard = hard.withColumn("rank", rank).filter(F.col("rank") <= NEGATIVES)
    pairs = positives.select("anchor", F.explode("found").alias("p")).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    pairs = pairs.select("anchor", "anchor_id", F.col("p.place").alias("place"), F.col("p.vec_id").alias("positive_id"),
                         F.col("p.score").alias("positive_score"))
    return hard.join(pairs, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                                                        "positive_score", F.col("score").alias("negative_score"))


by_value(__name__)
