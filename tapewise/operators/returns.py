"""Default-adjusted returns: by percentile cutoff, by category, by cutoff sweep.

default-adjusted return = average APR (percent) - 100 x default rate.
Averages skip NULLs everywhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewise.operators.profile import unpivot
from tapewise.operators.quantiles import wide_quantiles
from tapewise.operators.ranges import SINGLE_LIMIT, running_sum_desc


def _ret(avg_apr, rate):
    return avg_apr - F.lit(100.0) * rate


def def_adj_rets(df: DataFrame, features: Sequence[str], up: Sequence[str], pct: float = 0.75,
                 label: str = "default_flag", apr: str = "apr", method: str = "exact",
                 accuracy: int = 10000) -> DataFrame:
    """Per feature: cutoff at the ``pct`` quantile (features in ``up``, keep x >= cutoff)
    or the ``1 - pct`` quantile (others, keep x <= cutoff); default rate, average APR
    and default-adjusted return of the kept rows; plus an ``All`` row.

    Two aggregates over the tape: one for all quantiles, one with conditional
    sums for all features (the quantile row is broadcast: it is one row).
    Returns ``field, direction, cutoff, n, default_rate, avg_apr, def_adj_return``.
    """
    p = pct / 100.0 if pct > 1 else float(pct)
    features = list(features)
    up = set(up)

    probs = {c: [p if c in up else 1.0 - p] for c in features}
    wide = wide_quantiles(df, features, probs, method=method, accuracy=accuracy)
    cuts = wide.select(*[F.col(f"__q_{c}_0").alias(f"__cut{i}") for i, c in enumerate(features)])
    j = df.crossJoin(F.broadcast(cuts))
    y = F.col(label)
    a = F.col(apr)
    aggs = [F.count(F.lit(1)).alias("__n_all"), F.avg(y).alias("__rate_all"), F.avg(a).alias("__apr_all")]
    for i, c in enumerate(features):
        x = F.col(c).cast("double")
        mask = x >= F.col(f"__cut{i}") if c in up else x <= F.col(f"__cut{i}")
        aggs += [
            F.first(F.col(f"__cut{i}")).alias(f"__c{i}"),
            F.count_if(mask).alias(f"__n{i}"),
            F.sum(F.when(mask, y)).alias(f"__d{i}"),
            F.avg(F.when(mask, a)).alias(f"__a{i}"),
        ]
    wide = j.agg(*aggs)
    parts = []
    for i, c in enumerate(features):
        direction = "positive" if c in up else "negative"
        parts.append(f"'{c}', '{direction}', __c{i}, __n{i}, "
                     f"try_divide(cast(__d{i} AS double), cast(__n{i} AS double)), __a{i}")
    parts.append("'All', 'NA', 0.0D, __n_all, __rate_all, __apr_all")
    long = wide.selectExpr(
        f"stack({len(parts)}, {', '.join(parts)}) AS (field, direction, cutoff, n, default_rate, avg_apr)")
    return long.withColumn("def_adj_return", _ret(F.col("avg_apr"), F.col("default_rate")))


def return_by_category(df: DataFrame, cols: Sequence[str], label: str = "default_flag",
                       apr: str = "apr") -> DataFrame:
    """``field, value, default_rate, avg_apr, def_adj_return, freq`` per category value.

    One unpivot and one grouped aggregate for all fields; NULL categories are left out.
    """
    long = unpivot(df, cols, keep=[label, apr]).filter(F.col("value").isNotNull())
    agg = long.groupBy("field", "value").agg(
        F.avg(F.col(label).cast("double")).alias("default_rate"),
        F.avg(apr).alias("avg_apr"),
        F.count(F.lit(1)).alias("freq"))
    return agg.withColumn("def_adj_return", _ret(F.col("avg_apr"), F.col("default_rate")))


def select_alpha_values(df: DataFrame, cols: Sequence[str], share: float = 0.2, label: str = "default_flag",
                        apr: str = "apr", order_digits: int = 9, n_ranges: int | None = None) -> DataFrame:
    """Per field, values in descending return order while the frequency total
    before the value is at most ``floor(n x share)`` (n = all rows).

    Ties in return (after rounding to ``order_digits`` places, which removes
    float noise) are broken by value ascending; NULL returns come last.  The
    frequency before a value is the total of strictly higher returns (a
    distributed running sum over the distinct returns, ``ranges.running_sum_desc``)
    plus the tied values before it (a window over the ties only).
    Returns ``field, value, def_adj_return, freq, freq_before``.
    """
    if n_ranges is None:
        # distinct returns per field <= distinct values of the field: one HyperLogLog pass over the
        # raw columns bounds them without running the per-category pipeline
        card = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"__nd{i}") for i, c in enumerate(cols)]).first()
        if max(card) + 1 <= 0.9 * SINGLE_LIMIT:
            n_ranges = 1
    rets = return_by_category(df, cols, label, apr).withColumn(
        "__key", F.coalesce(F.round("def_adj_return", order_digits), F.lit(float("-inf"))))
    per_key = rets.groupBy("field", "__key").agg(F.sum("freq").alias("__tot"))
    run = running_sum_desc(per_key, "__key", ["__tot"], n_ranges, by=["field"])
    higher = run.select("field", "__key", (F.col("cum___tot") - F.col("__tot")).alias("__higher"))
    ties = Window.partitionBy("field", "__key").orderBy(F.asc("value")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rets.join(higher, ["field", "__key"]).withColumn(
        "freq_before", (F.col("__higher") + F.coalesce(F.sum("freq").over(ties), F.lit(0))).cast("bigint"))
    total = df.agg(F.floor(F.count(F.lit(1)) * F.lit(float(share))).alias("__quota"))
    return (ranked.crossJoin(F.broadcast(total))
            .filter(F.col("freq_before") <= F.col("__quota"))
            .select("field", "value", "def_adj_return", "freq", "freq_before"))


def cutoff_sweep(df: DataFrame, col: str, start: float, stop: float, step: float,
                 label: str = "default_flag", apr: str = "apr") -> DataFrame:
    """For each cutoff in ``arange(start, stop, step)``: rows with value >= cutoff,
    their default rate, average APR and default-adjusted return.

    Instead of a theta join of cutoffs x rows, each row is assigned to the
    highest cutoff it passes, aggregated per cutoff, and a reverse running sum
    over the cutoffs (a parameter-sized table) gives the "value >= cutoff" totals.
    Returns ``cutoff, n, default_rate, avg_apr, def_adj_return``.
    """
    if step <= 0:
        raise ValueError("step must be positive")
    n_cut = max(int(math.ceil((stop - start) / step)), 0)
    spark = df.sparkSession
    x = F.col(col).cast("double")
    s0 = F.lit(float(start))
    st = F.lit(float(step))
    i0 = F.floor((x - s0) / st)
    idx = (F.when(x < s0 + i0 * st, i0 - 1)
           .when(x >= s0 + (i0 + 1) * st, i0 + 1)
           .otherwise(i0))
    idx = F.least(idx, F.lit(n_cut - 1))
    # least() skips NULLs, so rows without a value are removed before bucketing
    rows = df.filter(x.isNotNull()) \
             .select(idx.alias("idx"), F.col(label).alias("__y"), F.col(apr).alias("__a")) \
             .filter(F.col("idx") >= 0)
    per = rows.groupBy("idx").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__y").alias("__d"),
        F.sum("__a").alias("__sa"), F.count("__a").alias("__na"))
    grid = spark.range(n_cut).select(F.col("id").alias("idx"))
    j = grid.join(per, "idx", "left").na.fill(0, ["__n", "__d", "__na"]).na.fill(0.0, ["__sa"])
    w = Window.orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = j.select(
        "idx",
        F.sum("__n").over(w).alias("n"),
        F.sum("__d").over(w).alias("__d"),
        F.sum("__sa").over(w).alias("__sa"),
        F.sum("__na").over(w).alias("__na"))
    rate = F.try_divide(F.col("__d").cast("double"), F.col("n").cast("double"))
    avg_apr = F.try_divide(F.col("__sa"), F.col("__na").cast("double"))
    return cum.select(
        (s0 + F.col("idx") * st).alias("cutoff"),
        F.col("n").cast("bigint").alias("n"),
        rate.alias("default_rate"),
        avg_apr.alias("avg_apr"),
        _ret(avg_apr, rate).alias("def_adj_return")).orderBy("cutoff")


def argmax_row(df: DataFrame, param: str, metric: str) -> DataFrame:
    """Row with the largest metric; on ties the smallest parameter (first in a sweep)."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), F.asc(param)).limit(1)
