"""Reproducible splits, folds and feature scaling.

Every split is a pure function of (seed, key): a seeded md5 hash of the row
key.  The default splits are hash thresholds, a narrow filter without a
shuffle whose sizes are exact in expectation.  The ``exact`` variants need a
rank in hash order; ``hash_rank`` computes it without a global sort or a
single-partition window:

1. rows are bucketed by the top bits of the hash (2**20 buckets);
2. bucket counts (a small aggregated table) give each bucket's offset with a
   window per stratum;
3. the rank is offset + row_number within (stratum, bucket), a window over
   many small partitions.  The offsets join uses the same partitioning.

The key must identify rows (unique), as every split and fold assumes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewise.functions.exprs import HASH_SPACE, hash_int
from tapewise.operators.ranges import join_on_keys

HASH_BUCKET_SHIFT = 12  # 32-bit hash >> 12 -> 2**20 buckets


def hash_rank(df: DataFrame, key: str, seed: int, strata: Sequence[str] = (),
              rank_col: str = "__rank", n_col: str = "__n_stratum") -> DataFrame:
    """Append the exact 1-based rank of each row in (hash, key) order within its stratum,
    and the stratum size."""
    strata = list(strata)
    h = hash_int(key, seed)
    rows = df.withColumn("__h", h).withColumn("__b", F.shiftright(F.col("__h"), HASH_BUCKET_SHIFT))
    counts = rows.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(*strata).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*strata)
    offsets = counts.select(*strata, "__b",
                            F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"),
                            F.sum("__cnt").over(whole).alias(n_col))
    j = join_on_keys(rows, offsets, [*strata, "__b"])
    within = Window.partitionBy(*strata, "__b").orderBy("__h", key)
    return j.withColumn(rank_col, F.col("__off") + F.row_number().over(within)).drop("__off", "__b")


def random_split(df: DataFrame, key: str, frac: float = 0.2, seed: int = 3, exact: bool = False,
                 out: str = "part") -> DataFrame:
    """``part`` = 'test' for a ``frac`` sample, else 'train'.

    Hash threshold by default (no shuffle); ``exact=True`` takes exactly
    ``floor(frac x n + 0.5)`` rows, the smallest in hash order.
    """
    if not exact:
        is_test = hash_int(key, seed) / F.lit(HASH_SPACE) < F.lit(float(frac))
        return df.withColumn(out, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    return _exact_split(df, key, frac, seed, [], out)


def stratified_split(df: DataFrame, key: str, label: str, frac: float = 0.2, seed: int = 123,
                     exact: bool = True, out: str = "part") -> DataFrame:
    """Split with the same label mix in both parts.

    ``exact=True``: per label, the ``floor(frac x n_label + 0.5)`` rows first in
    hash order are 'test'.  ``exact=False``: hash threshold (mix kept in expectation).
    """
    if not exact:
        return random_split(df, key, frac, seed, exact=False, out=out)
    return _exact_split(df, key, frac, seed, [label], out)


def _exact_split(df: DataFrame, key: str, frac: float, seed: int, strata: list[str], out: str) -> DataFrame:
    ranked = hash_rank(df, key, seed, strata)
    quota = F.floor(F.col("__n_stratum") * F.lit(float(frac)) + F.lit(0.5))
    res = ranked.withColumn(out, F.when(F.col("__rank") <= quota, F.lit("test")).otherwise(F.lit("train")))
    return res.drop("__rank", "__n_stratum", "__h")


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 0, exact: bool = False, out: str = "fold") -> DataFrame:
    """Shuffled k folds as a ``fold`` column (feeds ``CrossValidator(foldCol=...)``).

    Hash modulo k by default; ``exact=True`` deals rows round-robin in hash
    order, so fold sizes differ by at most one.
    """
    if not exact:
        return df.withColumn(out, F.pmod(hash_int(key, seed), F.lit(k)).cast("int"))
    ranked = hash_rank(df, key, seed)
    return ranked.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "__n_stratum", "__h")


def repeated_kfold(df: DataFrame, key: str, k: int = 4, repeats: int = 4, seed: int = 0,
                   out: str = "fold", repeat_col: str = "repeat") -> DataFrame:
    """``repeats`` independent k-fold assignments (seed + repeat), one row per (row, repeat)."""
    rep = df.withColumn(repeat_col, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    text = F.concat((F.lit(seed) + F.col(repeat_col)).cast("string"), F.lit(":"), F.col(key).cast("string"))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return rep.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))


def complement_split(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``sample`` (left anti join)."""
    return df.join(sample.select(key), key, "left_anti")


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: Column | DataFrame | None = None,
                 suffix: str = "", method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """(x - median) / IQR with an IQR of 0 treated as 1.

    Statistics come from ``fit_on`` (a predicate selecting the training rows, a
    training DataFrame, or all rows), computed in one aggregate and broadcast
    as one row.
    """
    cols = list(cols)
    if isinstance(fit_on, DataFrame):
        base = fit_on
    elif fit_on is not None:
        base = df.filter(fit_on)
    else:
        base = df

    from tapewise.operators.quantiles import wide_quantiles

    stats = wide_quantiles(base, cols, [0.25, 0.5, 0.75], method=method, accuracy=accuracy)
    j = df.crossJoin(F.broadcast(stats))  # one row
    scaled = {}
    for c in cols:
        q1, q2, q3 = (F.col(f"__q_{c}_{i}") for i in range(3))
        iqr = q3 - q1
        den = F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
        scaled[f"{c}{suffix}"] = (F.col(c).cast("double") - q2) / den
    return j.withColumns(scaled).drop(*[f"__q_{c}_{i}" for c in cols for i in range(3)])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """Feature vector via ``VectorAssembler``."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)
