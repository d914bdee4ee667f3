"""Cross-validated scoring, parameter sweeps and model comparisons.

Fits are Spark ML jobs driven from the driver (one per fold, parameter
value or model); every metric afterwards is computed on the union of the
scored rows with a group column, so k folds or m models cost one metric job,
not k or m.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewise.operators import curves as C
from tapewise.operators.models import LABEL, FeatureSpec, fit_score, prepare, score_column
from tapewise.operators.split import kfold
from tapewise.operators.trees import FEATURES, Tree, TreePlan, grow_trees
from tapewise.session import stored


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def classification_scores(estimator, data: DataFrame, key: str, folds: int = 3, seed: int = 0,
                          name: str = "model") -> tuple[DataFrame, object]:
    """Fit on all rows (training accuracy), k-fold out-of-fold predictions, AUC of the
    hard out-of-fold labels, its confusion counts, per-fold AUC / accuracy /
    majority baseline means.  Returns (one-row DataFrame, model fitted on all rows).

    ``data`` is prepared (``key, label, features``).  An estimator has ``fit(data)``, its model ``transform(df)``,
    which adds ``prediction`` and either ``score`` or Spark ML's columns.  The k fold fits run side by side and are
    reused for both the pooled and the per-fold metrics.
    """
    # the fits, the scoring passes and the training accuracy each read the data: write it once
    f = stored(kfold(data, key, folds, seed), "folded")
    data = f.drop("fold")

    def out_of_fold(i):
        m = estimator.fit(f.filter(F.col("fold") != i))
        return (m.transform(f.filter(F.col("fold") == i))
                .select(key, LABEL, "fold", F.col("prediction").cast("int").alias("prediction"), score_column(m).alias("score")))

    with ThreadPoolExecutor(max_workers=folds + 1) as pool:
        whole = pool.submit(estimator.fit, data)
        parts = list(pool.map(out_of_fold, range(folds)))
        full = whole.result()
    train_acc = full.transform(data).agg(
        F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("train_accuracy"))
    oof = stored(_union(parts), "out-of-fold")
    pooled_auc = C.roc_auc(oof, LABEL, F.col("prediction"))
    conf = C.accuracy_stats(oof, LABEL, "prediction").select("tp", "fp", "fn", "tn")
    per_fold = C.roc_auc(oof, LABEL, F.col("prediction"), by=["fold"]) \
        .join(oof.groupBy("fold").agg(F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("acc")), "fold") \
        .join(C.majority_baseline(oof, "fold", LABEL).select("fold", "baseline"), "fold") \
        .agg(F.avg("auc_roc").alias("mean_fold_auc"), F.avg("acc").alias("mean_fold_accuracy"),
             F.avg("baseline").alias("mean_baseline"))
    out = train_acc.crossJoin(pooled_auc.withColumnRenamed("auc_roc", "auc_hard")).crossJoin(conf).crossJoin(per_fold)
    return out.select(F.lit(name).alias("model"), "*"), full


def tree_for(params: Mapping[str, float], n_train: int, key: str, seed: int = 10) -> Tree:
    """One exact decision tree with sklearn's parameters; fractions mean shares of the training rows, rounded up."""
    unknown = set(params) - {"min_samples_split", "min_samples_leaf", "max_depth", "max_features"}
    if unknown:
        raise ValueError(f"unknown tree parameters {sorted(unknown)}")

    def rows(name, least):
        return max(least, math.ceil(float(params.get(name, 0.0)) * n_train))

    depth, features = params.get("max_depth"), params.get("max_features")
    return Tree(seed, key, None if features is None else int(features), rows("min_samples_leaf", 1), rows("min_samples_split", 2),
                None if depth is None else int(depth))


def _reaching(weight: float):
    """Number of nodes on the path that have at least this weight."""
    return F.size(F.filter("path_n", lambda n: n >= weight))


def sweep_scores(train: DataFrame, test: DataFrame, grids: Mapping[str, Sequence], key: str, seed: int = 10) -> DataFrame:
    """``key, label, param, value, score`` of the test rows for every value of every grid, from one growth and one scoring pass.

    A greedy tree's node does not depend on what is grown below it, so every ``max_depth`` and ``min_samples_split``
    is read off the full tree's root-to-leaf paths; other parameters get a tree per value, all grown together.
    """
    n_train, plans, points = train.count(), {}, []
    for param, values in grids.items():
        for v in values:
            own = param not in ("max_depth", "min_samples_split")
            est = tree_for({param: v} if own else {}, n_train, key, seed)
            plan = (est.max_features, est.min_leaf)
            tree = plans.setdefault(plan, len(plans))
            points.append((param, float(v), tree))
    grown = grow_trees(train, key, [TreePlan(t, seed, False, m, leaf) for (m, leaf), t in plans.items()], Tree.local_rows)
    last = F.size("path_p") - 1
    read = []
    for param, v, tree in points:
        at = last
        if param == "max_depth":
            at = F.least(F.lit(int(v)), last)
        elif param == "min_samples_split":  # weights fall along the path: the first node below the bound is the leaf
            at = F.least(_reaching(float(max(2, math.ceil(v * n_train)))), last)
        read.append(F.when(F.col("tree") == tree, F.struct(F.lit(param).alias("param"), F.lit(v).alias("value"), F.get("path_p", at).alias("score"))))
    test = stored(test.select(key, LABEL, FEATURES), "sweep-rows")
    found = grown.root_to_leaf(test).select(key, F.explode(F.array_compact(F.array(*read))).alias("s")).select(key, "s.*")
    return found.join(test.select(key, LABEL), key)


def sweep(train: DataFrame, test: DataFrame, param: str, values: Sequence, key: str, seed: int = 10) -> DataFrame:
    """``param, value, pr_auc`` (area with the (0, 1) anchor, on ``test``) of one tree per value."""
    return _areas(sweep_scores(train, test, {param: values}, key, seed))


def _areas(scored: DataFrame) -> DataFrame:
    areas = C.pr_auc(stored(scored, "sweep-scores"), LABEL, "score", by=["param", "value"])
    return areas.select("param", "value", F.col("pr_auc_one").alias("pr_auc"))


def sweep_areas(train: DataFrame, test: DataFrame, grids: Mapping[str, Sequence], key: str, seed: int = 10) -> DataFrame:
    """``param, value, pr_auc`` of every value of every grid."""
    return _areas(sweep_scores(train, test, grids, key, seed))


def best_values(areas: DataFrame) -> dict[str, float]:
    """Per parameter the first (smallest) value with the largest area."""
    top = areas.groupBy("param").agg(F.max(F.struct("pr_auc", (-F.col("value")).alias("low"))).alias("top"))
    return {r["param"]: -r["low"] for r in top.select("param", "top.low").collect()}  # one row per parameter


def tune_and_refit(train: DataFrame, test: DataFrame, grids: Mapping[str, Sequence], key: str, seed: int = 10) -> tuple[DataFrame, DataFrame]:
    """Sweep each parameter, combine the best values, refit and rescore.

    Returns (all sweep rows, one row of test metrics for the tuned tree:
    accuracy, precision, recall, hard-label AUC and PR area).
    """
    allsw = stored(_areas(sweep_scores(train, test, grids, key, seed)), "sweeps")
    est = tree_for(best_values(allsw), train.count(), key, seed)
    _, scored = fit_score(est, train, test, key)
    scored = stored(scored, "tuned-scores")
    stats = C.accuracy_stats(scored, LABEL, "prediction")
    auc = C.roc_auc(scored, LABEL, F.col("prediction"))
    pr = C.pr_auc(scored, LABEL, "score").select(F.col("pr_auc_one").alias("pr_auc"))
    return allsw, stats.crossJoin(auc).crossJoin(pr)


def roc_comp(train: DataFrame, test: DataFrame, models: Mapping[str, object], key: str,
             parallelism: int = 4) -> tuple[DataFrame, DataFrame]:
    """Fit each model (concurrently, from a bounded thread pool), score the test rows, and return
    (``model, roc_auc, pr_auc, roc_auc_3, pr_auc_3``, the ROC curves by model).
    PR area drops the undefined first point (no anchor)."""

    def one(item):
        name, est = item
        _, s = fit_score(est, train, test, key)
        return s.withColumn("model", F.lit(name))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scored = list(pool.map(one, models.items()))
    allsc = stored(_union(scored), "compared-scores")
    roc = C.roc_auc(allsc, LABEL, "score", by=["model"])
    pr = C.pr_auc(allsc, LABEL, "score", by=["model"]).select("model", F.col("pr_auc_none").alias("pr_auc"))
    table = roc.join(pr, "model").select(
        "model", F.col("auc_roc").alias("roc_auc"), "pr_auc",
        F.round("auc_roc", 3).alias("roc_auc_3"), F.round("pr_auc", 3).alias("pr_auc_3"))
    return table, C.roc_curve(allsc, LABEL, "score", by=["model"])


def first_trees(model, n: int):
    """The boosted model of the first ``n`` trees of ``model``: boosting is sequential, so a fit of ``n`` iterations gives the same."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(n):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    return GBTClassificationModel(gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights))


def repeated_cv_search(estimator, grid: Sequence[Mapping[str, object]], data: DataFrame, key: str,
                       k: int = 4, repeats: int = 4, seed: int = 0, parallelism: int = 4) -> tuple[DataFrame, dict]:
    """Grid search with repeated k-fold cross-validation (``repeatedcv`` style).

    Each (grid point, repeat, fold) is one fit, run from a bounded thread
    pool; boosted points that differ in their tree count only share the largest
    one's fit, as caret does.  Every held-out prediction is tagged and the per-fold ROC AUCs are
    computed in one grouped job.  Returns (``combo, params, mean_auc, sd_auc,
    n_folds`` per grid point, best parameter dict by mean AUC, first on ties).
    """
    from tapewise.operators.split import repeated_kfold

    folded = repeated_kfold(data, key, k=k, repeats=repeats, seed=seed).persist()
    boosted = isinstance(estimator, GBTClassifier)
    fits: dict = {}  # points by all that a fit of their own needs
    for ci, g in enumerate(grid):
        fits.setdefault(tuple(sorted((n, v) for n, v in g.items() if n != "maxIter" or not boosted)), []).append(ci)
    tasks = [(cis, r, f) for cis in fits.values() for r in range(repeats) for f in range(k)]

    def one(task):
        cis, r, f = task
        trees = {ci: grid[ci].get("maxIter", estimator.getOrDefault("maxIter")) for ci in cis} if boosted else {}
        largest = max(cis, key=lambda ci: trees.get(ci, 0))
        est = estimator.copy({estimator.getParam(n): v for n, v in grid[largest].items()})
        part = folded.filter(F.col("repeat") == r)
        full = est.fit(part.filter(F.col("fold") != f))
        out = []
        for ci in cis:
            model = full if ci == largest else first_trees(full, trees[ci])
            out.append(model.transform(part.filter(F.col("fold") == f))
                       .select(key, LABEL, score_column(model).alias("score"))
                       .withColumns({"combo": F.lit(ci), "rep": F.lit(r), "fold": F.lit(f)}))
        return out

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scored = [s for out in pool.map(one, tasks) for s in out]
    per_fold = C.roc_auc(_union(scored), LABEL, "score", by=["combo", "rep", "fold"])
    summary = per_fold.groupBy("combo").agg(F.avg("auc_roc").alias("mean_auc"), F.stddev_samp("auc_roc").alias("sd_auc"),
                                            F.count(F.lit(1)).alias("n_folds"))
    labels = data.sparkSession.createDataFrame(
        [(i, ", ".join(f"{n}={v}" for n, v in sorted(g.items()))) for i, g in enumerate(grid)], "combo int, params string")
    summary = summary.join(F.broadcast(labels), "combo").select("combo", "params", "mean_auc", "sd_auc", "n_folds")
    best = summary.orderBy(F.desc("mean_auc"), "combo").first()
    return summary, dict(grid[best["combo"]]) if best else {}


def nested_feature_models(train_raw: DataFrame, test_raw: DataFrame, feature_sets: Mapping[str, FeatureSpec],
                          models: Callable[[int], Mapping[str, object]], key: str,
                          parallelism: int = 4) -> DataFrame:
    """``roc_comp`` for each feature set: ``feature_set, model, roc_auc, pr_auc``.

    Feature sets are prepared and compared concurrently (bounded thread pool)."""

    def one(item):
        name, spec = item
        tr, te, _ = prepare(train_raw, test_raw, spec)
        tr, te = stored(tr, "train-part"), stored(te, "test-part")
        table, _ = roc_comp(tr, te, models(tr.count()), key, parallelism=parallelism)
        return table.withColumn("feature_set", F.lit(name))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(feature_sets)))) as pool:
        out = list(pool.map(one, feature_sets.items()))
    return _union(out).select("feature_set", "model", "roc_auc", "pr_auc")


__all__ = ["classification_scores", "sweep", "tune_and_refit", "roc_comp", "nested_feature_models", "repeated_cv_search",
           "sweep_areas", "sweep_scores", "tree_for", "best_values"]
