"""Profiling: counts, summaries, distinct values, crosstabs, chart data.

Many-column profiles unpivot the columns into ``(field, value)`` rows and
run ONE grouped aggregate instead of one job per column; partial
aggregation collapses each task's rows before the shuffle, so a hot value
(or a hot field) costs one row per task, not one task for all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewise.functions.exprs import hash_int
from tapewise.operators.quantiles import quantiles
from tapewise.operators.ranges import join_on_keys

QUARTILES = (0.25, 0.5, 0.75)


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), value_type: str = "string",
            field: str = "field", value: str = "value") -> DataFrame:
    """``(keep..., field, value)`` rows, one per input column; values cast to one type."""
    staged = df.select(*keep, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return staged.unpivot(list(keep), list(cols), field, value)


def value_counts(df: DataFrame, cols: Sequence[str], dropna: bool = False) -> DataFrame:
    """``field, value, n`` for every column in ``cols`` (values as strings)."""
    long = unpivot(df, cols)
    if dropna:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _summary(long: DataFrame, keys: Sequence[str], method: str, accuracy: int) -> DataFrame:
    long = long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))  # NaN counts as missing
    x = F.col("value")
    main = long.groupBy(*keys).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"))
    q = quantiles(long, keys, "value", QUARTILES, method=method, accuracy=accuracy).drop("n")
    out = join_on_keys(main, q, keys, "left")
    return out.select(*keys, "count", "mean", "std", "min",
                      F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def describe(df: DataFrame, cols: Sequence[str], method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75% (linear interpolation), max per column.

    Quantiles are exact by default (distributed rank selection, see
    ``operators.quantiles``); ``method='approx'`` uses a bounded sketch.
    """
    return _summary(unpivot(df, cols, value_type="double"), ["field"], method, accuracy)


def describe_by(df: DataFrame, cols: Sequence[str], by: str, method: str = "exact",
                accuracy: int = 10000) -> DataFrame:
    return _summary(unpivot(df, cols, keep=[by], value_type="double"), ["field", by], method, accuracy)


def n_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``field, n_distinct`` (NULL not counted, pandas) and ``n_distinct_with_null`` (NA is a value, R)."""
    per_value = unpivot(df, cols).groupBy("field", "value").agg(F.count(F.lit(1)).alias("__n"))
    return per_value.groupBy("field").agg(
        F.count("value").alias("n_distinct"),
        F.count(F.lit(1)).alias("n_distinct_with_null"))


def unique_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def crosstab(df: DataFrame, a: str, b: str, margins: bool = True, wide: bool = False,
             total: str = "All") -> DataFrame:
    """Contingency counts of two columns (rows with a NULL in either are dropped).

    Long form ``a, b, n`` with ``total`` margins from ``cube``; ``wide=True``
    pivots ``b`` into columns (plus a ``total`` column and row when ``margins``);
    its levels, which become columns, are read first.
    """
    base = df.select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)) \
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    if wide:
        levels = [r[0] for r in base.select(b).distinct().orderBy(b).collect()]
        counts = [F.count_if(F.col(b) == F.lit(v)).alias(v) for v in levels] + ([F.count(F.lit(1)).alias(total)] if margins else [])
        if not margins:
            return base.groupBy(a).agg(*counts) if counts else base.select(a).distinct()
        whole = base.rollup(a).agg(*counts, F.grouping(a).alias("__g"))
        return whole.select(F.when(F.col("__g") == 1, F.lit(total)).otherwise(F.col(a)).alias(a), *[F.col(f"`{v}`") for v in [*levels, total]])
    if not margins:
        return base.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    cube = base.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("__ga"), F.grouping(b).alias("__gb"))
    return cube.select(
        F.when(F.col("__ga") == 1, F.lit(total)).otherwise(F.col(a)).alias(a),
        F.when(F.col("__gb") == 1, F.lit(total)).otherwise(F.col(b)).alias(b),
        "n")


def default_rate_by(df: DataFrame, col: str, label: str = "default_flag") -> DataFrame:
    """``value, mean_default, n`` per non-NULL value, highest default rate first."""
    return (df.filter(F.col(col).isNotNull())
            .groupBy(F.col(col).alias("value"))
            .agg(F.avg(label).alias("mean_default"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("mean_default"), F.asc("value")))


def default_rates_by_field(df: DataFrame, cols: Sequence[str], label: str = "default_flag") -> DataFrame:
    """``default_rate_by`` over many fields in one grouped aggregate: ``field, value, mean_default, n``."""
    long = unpivot(df, cols, keep=[label]).filter(F.col("value").isNotNull())
    return long.groupBy("field", "value").agg(F.avg(label).alias("mean_default"), F.count(F.lit(1)).alias("n"))


def mean_by_ordered(df: DataFrame, col: str, by: str, order: Sequence) -> DataFrame:
    """Mean of ``col`` per ``by`` level in a fixed level order; absent levels get NULL."""
    spark = df.sparkSession
    levels = spark.createDataFrame([(i, v) for i, v in enumerate(order)], f"ord int, {by} string")
    means = df.groupBy(F.col(by).cast("string").alias(by)).agg(F.avg(col).alias(f"mean_{col}"))
    return F.broadcast(levels).join(means, by, "left").select(by, "ord", f"mean_{col}").orderBy("ord")


def _hist_stats(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))


def _bin_expr(bins: int) -> Column:
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    idx = F.floor(F.try_divide(F.col("value") - F.col("__lo"), width))
    return F.least(F.coalesce(idx, F.lit(0)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width counts per column: ``field, bin, bin_lower, bin_upper, n``; empty bins have n = 0.

    The last bin is closed on the right, like ``numpy.histogram``.
    """
    return histogram_by(df, cols, by=None, bins=bins)


def histogram_by(df: DataFrame, cols: Sequence[str], by: str | None, bins: int = 10) -> DataFrame:
    """Histogram split by ``by`` with edges shared across groups (one grid per field)."""
    keep = [by] if by else []
    long = unpivot(df, cols, keep=keep, value_type="double").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    stats = _hist_stats(long, ["field"])
    binned = long.join(F.broadcast(stats), "field").withColumn("bin", _bin_expr(bins))
    counts = binned.groupBy("field", *keep, "bin").agg(F.count(F.lit(1)).alias("n"))
    # the zero-filled grid: every (field[, level]) present in the data times the bins,
    # built from the distinct pairs (no cross join) and the per-field stats (one row per field)
    pairs = long.select("field", *keep).distinct() if by else stats.select("field")
    grid = pairs.join(F.broadcast(stats), "field") \
                .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    out = join_on_keys(grid, counts, ["field", *keep, "bin"], "left")
    return out.select(
        "field", *keep, "bin",
        (F.col("__lo") + F.col("bin") * width).alias("bin_lower"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("bin_upper"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def stacked_amount(df: DataFrame, col: str, by: str, amount: str, out: str = "total_amount") -> DataFrame:
    return df.groupBy(col, by).agg(F.sum(amount).alias(out))


def stacked_count(df: DataFrame, col: str, by: str) -> DataFrame:
    return df.groupBy(col, by).agg(F.count(F.lit(1)).alias("n"))


def share_by(df: DataFrame, cols: Sequence[str], dropna: bool = False) -> DataFrame:
    """Pie data: ``field, value, n, share`` where shares of a field sum to 1."""
    counts = value_counts(df, cols, dropna=dropna)
    # field totals: one row per field (bounded by the column list), joined back by broadcast
    totals = counts.groupBy("field").agg(F.sum("n").alias("__total"))
    return counts.join(F.broadcast(totals), "field").select(
        "field", "value", "n", (F.col("n") / F.col("__total")).alias("share"))


def box_stats(df: DataFrame, cols: Sequence[str], by: str, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Five-number summary per (field, by) with 1.5 x IQR whiskers and the outlier count."""
    long = unpivot(df, cols, keep=[by], value_type="double").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    q = quantiles(long, ["field", by], "value", QUARTILES, method=method, accuracy=accuracy)
    q = q.select("field", by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - F.lit(1.5) * iqr
    hi_fence = F.col("q3") + F.lit(1.5) * iqr
    # one row per (field, level of by); the planner broadcasts it where its size allows
    j = join_on_keys(long, q, ["field", by])
    v = F.col("value")
    return j.groupBy("field", by, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo_fence, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_fence, v)).alias("whisker_hi"),
        F.count_if((v < lo_fence) | (v > hi_fence)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def scatter_sample(df: DataFrame, x: str, y: str, hue: str, n: int, key: str, seed: int = 3) -> DataFrame:
    """Scatter points (blank ``hue`` removed), a reproducible sample of ``n`` rows in seeded-hash order.

    Sampling is the feature here; the ordered limit runs as a per-task top-n
    followed by a merge of ``n`` rows per task.
    """
    pts = df.select(key, x, y, hue).filter(F.col(hue).isNull() | (F.col(hue) != F.lit("")))
    return pts.orderBy(hash_int(key, seed), F.col(key)).limit(n)


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``: ``slope, intercept, r2, n``."""
    return df.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_count(F.col(y), F.col(x)).alias("n"))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (used to compare with other engines)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields])
