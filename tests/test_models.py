"""Models: seed-stable, probabilities in [0, 1], planted signal recovered, exact k-NN."""

import numpy as np
import pytest
from conftest import SF0001, SF001
from pyspark.sql import functions as F

from tapewise.functions.exprs import hash_unit
from tapewise.operators import curves as C
from tapewise.operators import models as M
from tapewise.operators import tune as T
from tapewise.operators.split import random_split
from tapewise.sources.fixture import labelled_tape, read_table


@pytest.fixture(scope="module")
def planted(spark):
    """The sf0.01 tape with a label that depends on apr and fico (10 % of labels flipped by hash)."""
    t = labelled_tape(spark, SF001).filter(F.col("apr").isNotNull())
    signal = (F.col("apr") > 9.0) != (F.coalesce(F.col("fico"), F.lit(575)) > 700)
    flip = hash_unit("loan_id", 99) < 0.1
    t = t.withColumn("planted", (signal != flip).cast("int"))
    t = random_split(t, "loan_id", 0.2, seed=3)
    spec = M.FeatureSpec(numeric=["apr", "fico", "dti"], categorical=["grade"], label="planted", key="loan_id")
    tr, te, _ = M.prepare(t.filter(F.col("part") == "train"), t.filter(F.col("part") == "test"), spec)
    return tr.persist(), te.persist(), spec


def _auc(scored):
    return C.roc_auc(scored, M.LABEL, "score").first().auc_roc


@pytest.mark.parametrize("name", ["forest", "gbt", "tree"])
def test_tree_models_recover_signal(planted, name):
    tr, te, _ = planted
    est = {"forest": M.random_forest(num_trees=20, max_depth=6, seed=1),
           "gbt": M.gradient_boosting(max_iter=20, step_size=0.3, max_depth=3),
           "tree": M.decision_tree(maxDepth=6)}[name]
    _, scored = M.fit_score(est, tr, te)
    assert _auc(scored) > 0.85
    probs = scored.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= probs[0] <= probs[1] <= 1.0


def test_linear_models_run(planted):
    tr, te, _ = planted
    for est in (M.logistic("sklearn", n_train=tr.count()), M.linear_svm(), M.gaussian_nb()):
        _, scored = M.fit_score(est, tr, te)
        assert scored.count() == te.count()


def test_ada_boost_recovers_signal_and_is_stable(planted):
    """Stumps form an additive model, so the planted label here is additive: apr + fico/100 (10 % flipped)."""
    from pyspark.ml.functions import vector_to_array

    tr, te, _ = planted
    x = vector_to_array(F.col("features"))
    relabel = lambda df: df.withColumn(
        "label", ((x[0] + x[1] / 100.0 > 15.0) != (hash_unit("loan_id", 7) < 0.1)).cast("double"))
    tr, te = relabel(tr), relabel(te)
    m1 = M.ada_boost(tr, n_estimators=25, learning_rate=0.5)
    m2 = M.ada_boost(tr, n_estimators=25, learning_rate=0.5)
    assert [(s.feature, s.threshold) for s in m1.stumps] == [(s.feature, s.threshold) for s in m2.stumps]
    assert {s.feature for s in m1.stumps} <= {0, 1}
    assert _auc(m1.transform(te)) > 0.8


def test_feature_importance_names(planted):
    tr, _, spec = planted
    model = M.random_forest(num_trees=10, max_depth=4, seed=1).fit(tr)
    imp = M.feature_importance(model, spec.names).collect()
    assert {r.feature for r in imp} == set(spec.names)
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9


def test_knn_matches_brute_force(spark):
    e = read_table(spark, SF0001, "embeddings")
    is_test = hash_unit("vec_id", 5) < F.lit(0.3)
    train, test = e.filter(~is_test), e.filter(is_test)
    got = {r.vec_id: r.pred_label for r in M.knn_classify(train, test, "vec_id", "embedding", "label", k=3,
                                                          block_rows=50).collect()}
    tr = train.toPandas()
    te = test.toPandas()
    tv = np.stack(tr.embedding.to_numpy()).astype(np.float64)
    want = {}
    for _, row in te.iterrows():
        d = ((tv - np.asarray(row.embedding, dtype=np.float64)) ** 2).sum(axis=1)
        order = np.lexsort((tr.vec_id.to_numpy(), d))[:3]
        labels = tr.label.to_numpy()[order]
        vals, counts = np.unique(labels, return_counts=True)
        want[row.vec_id] = int(vals[np.argmax(counts)])
    assert got == want


def test_classification_scores_and_sweep(planted):
    tr, te, _ = planted
    out, _ = T.classification_scores(M.decision_tree(maxDepth=4), tr, "loan_id", folds=3)
    r = out.first()
    assert r.tp + r.fp + r.fn + r.tn == tr.count()
    assert r.auc_hard > 0.8 and 0.5 <= r.mean_baseline <= 1.0
    sw = T.sweep(tr, te, "max_depth", [1, 3, 5], "loan_id").collect()
    assert len(sw) == 3 and all(0 <= x.pr_auc <= 1 for x in sw)
    with pytest.raises(ValueError):
        T.tree_for({"max_leaves": 31}, 100, "loan_id")


def test_roc_comp_rows(planted):
    tr, te, _ = planted
    models = {"forest": M.random_forest(num_trees=10, max_depth=4, seed=1), "logistic": M.logistic("none")}
    table, curves = T.roc_comp(tr, te, models, "loan_id")
    rows = {r.model: r for r in table.collect()}
    assert set(rows) == {"forest", "logistic"} and rows["forest"].roc_auc > 0.8
    assert curves.select("model").distinct().count() == 2


def test_repeated_cv_search_picks_a_grid_point(planted):
    tr, _, _ = planted
    grid = [{"maxDepth": 1}, {"maxDepth": 4}]
    summary, best = T.repeated_cv_search(M.decision_tree(), grid, tr, "loan_id", k=2, repeats=2, parallelism=4)
    rows = {r.combo: r for r in summary.collect()}
    assert set(rows) == {0, 1} and all(r.n_folds == 4 for r in rows.values())
    assert best == {"maxDepth": 4}  # the planted interaction needs depth


def test_registered_grids_are_whole():
    from tapewise.plans import q_models as Q

    grids = Q.tuning_grids(11)
    assert {p: len(v) for p, v in grids.items()} == {"min_samples_split": 100, "min_samples_leaf": 50, "max_depth": 50, "max_features": 10}
    assert grids["min_samples_split"][-1] == 1.0 and grids["min_samples_leaf"][-1] == 0.5
    assert sorted((g["maxDepth"], g["maxIter"]) for g in Q.GBM_GRID) == [(d, n) for d in (1, 2, 3) for n in (50, 100, 150)]


@pytest.mark.parametrize("name, trees", [("random_forest", 1000), ("feature_importance", 1000), ("classification_scores_forest", 1000)])
def test_registered_forests_are_whole_and_end(spark, monkeypatch, name, trees):
    """The registered queries run to their end at sf0.001 with all trees."""
    from tapewise.operators import trees as T2
    from tapewise.plans import QUERIES

    grown, whole = [], T2.grow_trees
    monkeypatch.setattr(T2, "grow_trees", lambda data, key, plans, *a: grown.append(len(plans)) or whole(data, key, plans, *a))
    assert QUERIES[name](spark, SF0001).count() > 0
    assert set(grown) == {trees}


def test_boosted_points_share_a_fit(planted):
    tr, te, _ = planted
    long = M.gradient_boosting(max_iter=9, step_size=0.1, max_depth=2, seed=3).fit(tr)
    short = M.gradient_boosting(max_iter=4, step_size=0.1, max_depth=2, seed=3).fit(tr)
    cut = T.first_trees(long, 4)
    got, want = ({r[0]: r[1] for r in m.transform(te).select("loan_id", M.score_column(m)).collect()} for m in (cut, short))
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-9
    grid = [{"maxDepth": 1, "maxIter": n} for n in (3, 1, 2)]
    summary, _ = T.repeated_cv_search(M.gradient_boosting(step_size=0.1, seed=3), grid, tr, "loan_id", k=2, repeats=1)
    assert {(r.combo, r.params, r.n_folds) for r in summary.collect()} == {(i, f"maxDepth=1, maxIter={g['maxIter']}", 2) for i, g in enumerate(grid)}


def test_one_hot_feature_pipeline(spark):
    t = labelled_tape(spark, SF0001)
    spec = M.FeatureSpec(numeric=["apr"], categorical=["grade", "purpose"], one_hot=True)
    tr, _, _ = M.prepare(t, None, spec)
    n_grade = t.select("grade").distinct().count()
    n_purpose = t.select("purpose").distinct().count()
    # one column per level plus StringIndexer's slot for levels unseen in training (zero while fitting)
    assert len(tr.first().features) == 1 + (n_grade + 1) + (n_purpose + 1)
    _, scored = M.fit_score(M.logistic("none"), tr, tr)
    assert scored.count() == t.count()


def test_ada_boost_equals_a_direct_version(spark):
    """All cuts of all features, with a hot value, ties and a constant feature."""
    rng = np.random.default_rng(3)
    n = 500
    x = np.stack((np.round(rng.normal(size=n), 1), np.where(rng.random(n) < 0.6, 0.0, rng.integers(-3, 4, n)), np.ones(n)), axis=1)
    y = ((x[:, 0] > 0.3) ^ (rng.random(n) < 0.3)).astype(float)
    w, want = np.ones(n), []
    for _ in range(12):
        cuts = []
        for f in range(3):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                for left in (1.0, 0.0):
                    e = w[np.where(x[:, f] <= a, left, 1 - left) != y].sum() / n
                    cuts.append((round(e, 11), f, a + (b - a) / 2, -left, e))
        _, f, t, left, e = min(cuts)
        alpha = 0.4 * np.log((1 - e) / e)
        want.append((f, t, -left, e, alpha))
        w = w * np.exp(alpha * (np.where(x[:, f] <= t, -left, 1 + left) != y)) / ((1 - e) + e * np.exp(alpha))
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x.tolist(), y))], ["loan_id", "label", "features"])
    got = [(s.feature, s.threshold, s.left, s.error, s.alpha) for s in M.ada_boost(df, 12, 0.4).stumps]
    assert np.allclose(got, want, atol=1e-9)
    only = spark.createDataFrame([(1, 1.0, Vectors.dense([1.0])), (2, 1.0, Vectors.dense([2.0]))], ["loan_id", "label", "features"])
    assert [r.prediction for r in M.ada_boost(only, 5).transform(only).collect()] == [1, 1]


def test_knn_without_training_rows_and_as_an_estimator(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(i, float(i > 2), Vectors.dense([float(i), 1.0])) for i in range(6)], ["loan_id", "label", "features"])
    vec = df.withColumn("v", F.array(F.col("loan_id").cast("double")))
    got = M.knn_classify(vec.limit(0), vec, "loan_id", "v", "label", k=3).collect()
    assert len(got) == 6 and all(r.pred_label is None for r in got)
    found = {r.loan_id: (r.prediction, r.score) for r in M.Knn(1).fit(df).transform(df).collect()}
    assert found == {i: (int(i > 2), float(i > 2)) for i in range(6)}


@pytest.mark.parametrize("name", ["tree", "forest", "boosted", "ada", "knn"])
def test_classification_scores_takes_every_estimator(planted, name):
    from tapewise.operators.boosting import Boosted
    from tapewise.operators.trees import Forest, Tree

    tr, _, _ = planted
    est = {"tree": Tree(max_depth=4), "forest": Forest(15, max_depth=6), "boosted": Boosted(30, 2, 0.3), "ada": M.AdaBoost(15, 0.5),
           "knn": M.Knn(3)}[name]
    out, model = T.classification_scores(est, tr, "loan_id", folds=3, name=name)
    r = out.first()
    assert r.model == name and r.tp + r.fp + r.fn + r.tn == tr.count() and r.train_accuracy >= 0.5
    assert name == "knn" or r.auc_hard > 0.7


def test_bucketed_frame_models(spark):
    from tapewise.plans import QUERIES

    rows = QUERIES["bucketed_feature_models"](spark, SF0001).collect()
    assert {(r.feature_set, r.model) for r in rows} == {(f, m) for f in ("full", "top6", "top4") for m in ("random_forest", "logistic", "gradient_boosting")}
    assert all(0 <= r.roc_auc <= 1 and 0 <= r.pr_auc <= 1 for r in rows)
