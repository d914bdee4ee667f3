"""Exact trees: brute-force growth, the hand-over between Spark and a task, collapsed paths, forests by batches."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tapewise.functions import tree_kernel
from tapewise.operators import trees as T
from tapewise.operators import tune


def rows(n, seed, flip=0.2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 3] = rng.integers(0, 3, n)
    y = ((x[:, 0] + (x[:, 3] == 1) > 0.5) ^ (rng.random(n) < flip)).astype(float)
    return x, y


def frame(spark, x, y):
    data = [(int(i), float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x.tolist(), y))]
    return spark.createDataFrame(data, ["loan_id", "label", "features"]).repartition(4)


def brute_leaf(x, y, w, q, depth, plan):
    """Shares and weights along the path of row ``q``, growing only that path, all features tried."""
    n, n1 = w.sum(), (w * y).sum()
    path = [(n, n1 / n)]
    if n1 in (0, n) or n < plan.min_split or (plan.max_depth is not None and depth >= plan.max_depth):
        return path
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for low, high in zip(values, values[1:]):
            left = x[:, f] <= low
            l, r = w[left].sum(), w[~left].sum()
            if min(l, r) < plan.min_leaf:
                continue
            l1, r1 = (w * y)[left].sum(), (w * y)[~left].sum()
            score = (l1 * l1 + (l - l1) * (l - l1)) / l + (r1 * r1 + (r - r1) * (r - r1)) / r
            if best is None or score > best[0]:
                best = score, f, low + (high - low) / 2
    if best is None:
        return path
    side = x[:, best[1]] <= best[2]
    side = side if q[best[1]] <= best[2] else ~side
    return path + brute_leaf(x[side], y[side], w[side], q, depth + 1, plan)


PLANS = [T.TreePlan(0), T.TreePlan(1, min_leaf=5), T.TreePlan(2, min_split=40), T.TreePlan(3, max_depth=3), T.TreePlan(4, max_depth=0)]


@pytest.mark.parametrize("local_rows", [60, 1000])
def test_paths_equal_brute_force(spark, local_rows):
    x, y = rows(300, 1)
    model = T.grow_trees(frame(spark, x, y), "loan_id", PLANS, local_rows=local_rows, batch_trees=3)
    qx, _ = rows(40, 2)
    found = {(r.loan_id, r.tree): list(zip(r.path_n, r.path_p)) for r in model.root_to_leaf(frame(spark, qx, np.zeros(40))).collect()}
    for plan in PLANS:
        for i in range(40):
            want = brute_leaf(x, y, np.ones(300), qx[i], 0, plan)
            assert np.allclose(found[i, plan.tree], want), (plan, i)


def test_hand_over_changes_nothing(spark):
    x, y = rows(400, 3)
    data, test = frame(spark, x, y), frame(spark, *rows(60, 4))
    found = []
    for local in (50, 150, 10_000):
        model = T.Forest(6, seed=9, local_rows=local).fit(data)
        found.append(sorted((r.loan_id, round(r.score, 12)) for r in model.mean_share(test).collect()))
        gains = {r.feature: r.importance for r in model.importances("abcd").collect()}
        found.append({k: round(v, 9) for k, v in gains.items()})
    assert found[0] == found[2] == found[4] and found[1] == found[3] == found[5]
    assert abs(sum(found[1].values()) - 1) < 1e-6 and max(found[1], key=found[1].get) == "a"


def test_batches_sum_to_the_whole_forest(spark):
    x, y = rows(250, 5)
    data, test = frame(spark, x, y), frame(spark, *rows(30, 6))
    plans = [T.TreePlan(t, 2, True, 2) for t in range(7)]
    whole = {r.loan_id: r.score for r in T.grow_trees(data, "loan_id", plans).mean_share(test).collect()}
    parts = [T.grow_trees(data, "loan_id", plans[a:a + 3], batch_trees=2).root_to_leaf(test, whole=False) for a in (0, 3, 6)]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("loan_id").agg(F.sum("p").alias("s")).collect()
    assert all(abs(r.s / 7 - whole[r.loan_id]) < 1e-9 for r in summed) and len(summed) == 30


def test_forest_learns_and_draws_bootstraps(spark):
    x, y = rows(1500, 7, flip=0.05)
    qx, qy = rows(400, 8, flip=0.0)
    model = T.Forest(25, seed=1).fit(frame(spark, x, y))
    scored = model.transform(frame(spark, qx, qy)).collect()
    assert np.mean([r.prediction == r.label for r in scored]) > 0.93
    totals = [r.n[0] for r in model.subtrees.select("n").collect()]
    assert len(set(totals)) > 5 and abs(np.mean(totals) / 1500 - 1) < 0.05


def test_missing_values_and_constant_features(spark):
    x = np.array([[np.nan, 1.0], [1.0, 1.0], [2.0, 1.0], [np.nan, 1.0]])
    model = T.Tree().fit(frame(spark, x, np.array([1.0, 0, 0, 1])))
    assert {r.loan_id: r.prediction for r in model.transform(frame(spark, x, np.zeros(4))).collect()} == {0: 1, 1: 0, 2: 0, 3: 1}
    same = T.Tree(local_rows=2).fit(frame(spark, np.ones((5, 2)), np.array([1.0, 0, 0, 1, 1])))
    assert [round(r.score, 3) for r in same.transform(frame(spark, np.ones((1, 2)), np.zeros(1))).collect()] == [0.6]
    assert len(tree_kernel.feature_order(np.array([1], np.uint64), 0, 5)[0]) == 5


def test_sweeps_equal_separate_fits(spark):
    x, y = rows(300, 11)
    data, test = frame(spark, x, y), frame(spark, *rows(80, 12))
    for param, values in (("max_depth", [1, 2, 5, 50]), ("min_samples_split", [0.01, 0.2, 0.6, 1.0]), ("min_samples_leaf", [0.01, 0.1, 0.5]),
                          ("max_features", [1, 3])):
        swept = {(r.value, r.loan_id): r.score for r in tune.sweep_scores(data, test, {param: values}, "loan_id", seed=4).collect()}
        for v in values:
            alone = tune.tree_for({param: v}, 300, "loan_id", seed=4).fit(data).mean_share(test).collect()
            assert len(alone) == 80 and all(abs(swept[float(v), r.loan_id] - r.score) < 1e-12 for r in alone), (param, v)
