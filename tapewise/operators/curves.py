"""Confusion tables, accuracy statistics, exact ROC / PR curves and their areas.

Curves are exact (every distinct score is a threshold).  Rows are first
aggregated per distinct score (partial aggregation, so a score shared by a
third of the rows is one row per task).  The running totals in descending
score order are a distributed prefix sum: up to ``SINGLE_LIMIT`` distinct
scores a curve is one window partition; beyond that the scores are cut into
balanced ranges (approximate-quantile cut points, ``operators.ranges``),
range totals give each range's offset and a window partitioned by range adds
the running sum inside it.  No window runs over a large curve in one task.

Areas need no ordering beyond those running totals: the previous point of a
threshold is its running total minus its own counts, so each trapezoid is a
per-row expression and the area is a plain sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewise.functions.exprs import as_column
from tapewise.operators.ranges import SINGLE_LIMIT, join_on_keys, running_sum_desc

DEFAULT_RANGES = None  # adaptive (see ranges.running_sum_desc)


def score_counts(df: DataFrame, label: str, score: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """``[by...], threshold, pos, neg`` per distinct score, NULL and NaN left out (per group)."""
    by = list(by)
    s = as_column(score).cast("double")
    y = F.col(label)
    base = df.select(*by, s.alias("threshold"), y.alias("__y")) \
             .filter(F.col("threshold").isNotNull() & ~F.isnan("threshold") & F.col("__y").isNotNull())
    return base.groupBy(*by, "threshold").agg(
        F.sum(F.when(F.col("__y") == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col("__y") == 1, 0).otherwise(1)).cast("bigint").alias("neg"))


def cumulative_counts(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
                      by: Sequence[str] = ()) -> DataFrame:
    """``[by...], threshold, pos, neg, tp, fp, P, N`` where tp/fp count rows with score >= threshold."""
    by = list(by)
    if n_ranges is None:
        # distinct scores per curve from one HyperLogLog pass over the scored rows (no extra
        # aggregation of the scores): small curves run as one window partition each
        s = as_column(score).cast("double")
        nd = df.groupBy(*by).agg(F.approx_count_distinct(s, 0.02).alias("nd")).collect()  # one row per curve
        if max((r["nd"] for r in nd), default=0) <= 0.9 * SINGLE_LIMIT:
            n_ranges = 1
    counts = score_counts(df, label, score, by)
    run = running_sum_desc(counts, "threshold", ["pos", "neg"], n_ranges, by)
    run = run.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})
    tot = counts.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return join_on_keys(run, F.broadcast(tot), by)


def roc_curve(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
              by: Sequence[str] = ()) -> DataFrame:
    """``[by...], threshold, tp, fp, tpr, fpr`` for every distinct score (origin implied)."""
    c = cumulative_counts(df, label, score, n_ranges, by)
    return c.select(*by, "threshold", "tp", "fp",
                    F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("tpr"),
                    F.try_divide(F.col("fp").cast("double"), F.col("N").cast("double")).alias("fpr"))


def pr_curve(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
             by: Sequence[str] = ()) -> DataFrame:
    """``[by...], threshold, tp, fp, precision, recall`` (precision at its own threshold)."""
    c = cumulative_counts(df, label, score, n_ranges, by)
    return c.select(*by, "threshold", "tp", "fp",
                    F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
                    F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("recall"))


def threshold_curve(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
                    by: Sequence[str] = ()) -> DataFrame:
    return pr_curve(df, label, score, n_ranges, by).select(*by, "threshold", "precision", "recall")


def with_origin(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Prepend the point above the highest score (nothing predicted positive) to each curve,
    as curve libraries report it: tp = fp = 0, recall/tpr/fpr 0 and precision undefined (NULL)."""
    by = list(by)
    origins = curve.select(*by).distinct() if by else curve.sparkSession.range(1).select()
    fills = {}
    for f in curve.schema.fields:
        if f.name in by:
            continue
        if f.name == "threshold":
            fills[f.name] = F.lit(float("inf"))
        elif f.name == "precision":
            fills[f.name] = F.lit(None).cast("double")
        else:
            fills[f.name] = F.lit(0).cast(f.dataType)
    return curve.unionByName(origins.select(*by, *[v.alias(k) for k, v in fills.items()]))


def curve_drop_na(curve: DataFrame, col: str) -> DataFrame:
    """Drop points where ``col`` is undefined (NULL or NaN)."""
    return curve.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col)))


def _segments(df: DataFrame, label: str, score: str | Column, n_ranges: int | None, by: Sequence[str]) -> DataFrame:
    c = cumulative_counts(df, label, score, n_ranges, by)
    return c.withColumns({"__ptp": F.col("tp") - F.col("pos"), "__pfp": F.col("fp") - F.col("neg")})


def roc_auc(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
            by: Sequence[str] = ()) -> DataFrame:
    """Exact trapezoid area under the ROC curve (ties handled as one threshold): ``[by...], auc_roc``."""
    s = _segments(df, label, score, n_ranges, by)
    P = F.col("P").cast("double")
    N = F.col("N").cast("double")
    area = F.try_divide(F.col("neg") * (F.col("tp") + F.col("__ptp")).cast("double") / 2.0, P * N)
    return s.groupBy(*by).agg(F.sum(area).alias("auc_roc"))


def pr_auc(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
           by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under precision-recall with three anchors, one row per group:

    * ``pr_auc_one``   - the curve starts at (recall 0, precision 1);
    * ``pr_auc_none``  - no point before the highest threshold (the first segment is dropped);
    * ``pr_auc_first`` - the curve starts at (0, precision of the first point).
    """
    s = _segments(df, label, score, n_ranges, by)
    P = F.col("P").cast("double")
    rec = F.col("tp") / P
    prev_rec = F.col("__ptp") / P
    prec = F.col("tp") / (F.col("tp") + F.col("fp")).cast("double")
    first = (F.col("__ptp") + F.col("__pfp")) == 0
    prev_prec = F.try_divide(F.col("__ptp").cast("double"), (F.col("__ptp") + F.col("__pfp")).cast("double"))
    seg = lambda p0: (rec - prev_rec) * (prec + p0) / 2.0
    return s.groupBy(*by).agg(
        F.sum(F.when(first, seg(F.lit(1.0))).otherwise(seg(prev_prec))).alias("pr_auc_one"),
        F.sum(F.when(first, F.lit(0.0)).otherwise(seg(prev_prec))).alias("pr_auc_none"),
        F.sum(F.when(first, seg(prec)).otherwise(seg(prev_prec))).alias("pr_auc_first"))


def average_precision(df: DataFrame, label: str, score: str | Column, n_ranges: int | None = DEFAULT_RANGES,
                      by: Sequence[str] = ()) -> DataFrame:
    """``[by...], average_precision`` = sum over thresholds of (recall step) x precision."""
    s = _segments(df, label, score, n_ranges, by)
    P = F.col("P").cast("double")
    step = (F.col("tp") - F.col("__ptp")) / P
    prec = F.col("tp") / (F.col("tp") + F.col("fp")).cast("double")
    return s.groupBy(*by).agg(F.sum(step * prec).alias("average_precision"))


def threshold_crossing(curve: DataFrame) -> DataFrame:
    """Threshold where precision and recall are closest (smaller threshold on ties)."""
    gap = F.abs(F.col("precision") - F.col("recall"))
    return (curve.filter(F.col("precision").isNotNull() & F.col("recall").isNotNull())
            .withColumn("gap", gap).orderBy("gap", "threshold").limit(1)
            .select("threshold", "precision", "recall", "gap"))


def confusion(df: DataFrame, label: str, pred: str, margins: bool = True, total: str = "Total") -> DataFrame:
    """2 x 2 confusion counts in long form ``actual, predicted, n`` (all four cells present),
    with ``total`` row/column margins."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    counts = (df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull())
              .groupBy(F.col(label).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    cells = F.broadcast(grid).join(counts, ["actual", "predicted"], "left").na.fill(0, ["n"])
    if not margins:
        return cells.select(F.col("actual").cast("string"), F.col("predicted").cast("string"), "n")
    cube = cells.cube("actual", "predicted").agg(F.sum("n").alias("n"), F.grouping("actual").alias("__ga"),
                                                 F.grouping("predicted").alias("__gp"))
    return cube.select(
        F.when(F.col("__ga") == 1, F.lit(total)).otherwise(F.col("actual").cast("string")).alias("actual"),
        F.when(F.col("__gp") == 1, F.lit(total)).otherwise(F.col("predicted").cast("string")).alias("predicted"),
        F.col("n").cast("bigint").alias("n"))


def accuracy_stats(df: DataFrame, label: str, pred: str) -> DataFrame:
    """``n, tp, fp, fn, tn, accuracy, precision, recall`` in one aggregate (undefined ratios -> 0)."""
    y = F.col(label)
    p = F.col(pred)
    base = df.filter(y.isNotNull() & p.isNotNull())
    agg = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"))
    d = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return agg.select(
        "n", "tp", "fp", "fn", "tn",
        d(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        d(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        d(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def majority_baseline(df: DataFrame, fold: str, label: str) -> DataFrame:
    """Per fold, the accuracy of always predicting the majority class."""
    m = F.avg(F.col(label).cast("double"))
    return df.groupBy(fold).agg(F.greatest(m, F.lit(1.0) - m).alias("baseline"), F.count(F.lit(1)).alias("n"))


def compare_models(metrics: DataFrame, model: str = "model", metric: str = "metric", value: str = "value") -> DataFrame:
    """Long ``(model, metric, value)`` rows -> metric x model table."""
    return metrics.groupBy(metric).pivot(model).agg(F.first(value))
