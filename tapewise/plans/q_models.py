"""Registered queries: fitted models, cross-validation, tuning and comparisons.

Fitted-model outputs have no SQL twin (rows-only check) except those whose
numbers SQL can reproduce: the exact k-NN vote on ``embeddings``, Gaussian
naive Bayes (statistics, predictions and cross-validated scores) and the
logistic fits on one dummy.  The tape is random, so these queries
exercise the machinery; the planted-signal tests in ``tests/`` check that
the models learn.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tapewise.operators import clean
from tapewise.operators import curves as C
from tapewise.operators import models as M
from tapewise.operators import tune as T
from tapewise.operators.boosting import Boosted, TunedBoosted, boosted_cv
from tapewise.operators.portfolio import criteria_dummies
from tapewise.operators.split import random_split, robust_scale, stratified_split
from tapewise.operators.trees import Forest, Tree
from tapewise.plans.q_returns import ALL_SQL
from tapewise.plans.q_split import SPLIT_SQL, hash_sql
from tapewise.plans.q_tape import DTI_EDGES, INQ_EDGES
from tapewise.plans.registry import query, r6, tape_sql
from tapewise.session import stored
from tapewise.sources.fixture import labelled_tape, read_table

NUMERIC = ["apr", "fico", "inquiries_6m", "annual_income", "dti", "loan_amount", "revolving_util"]
CATEGORICAL = ["purpose", "home_ownership", "grade", "modified_flag"]


def _spec(numeric=NUMERIC, categorical=CATEGORICAL, one_hot: bool = False) -> M.FeatureSpec:
    return M.FeatureSpec(numeric=list(numeric), categorical=list(categorical), label="default_flag", key="loan_id",
                         one_hot=one_hot)


def _formula_spec() -> M.FeatureSpec:
    """The model-formula flow (factors dummy-coded), used by the three-model comparisons."""
    return _spec(one_hot=True)


def _model_tape(spark, d):
    """The labelled tape's model columns, derived once: preparation, fits and scoring each read them."""
    return stored(labelled_tape(spark, d).select("loan_id", "default_flag", *NUMERIC, *CATEGORICAL), "model-tape")


def _parts(spark, d, spec=None):
    """20 % hash test split of the tape, feature preparation fitted on the train part; both parts are written once."""
    t = random_split(_model_tape(spark, d), "loan_id", 0.2, seed=3)
    train = t.filter(F.col("part") == "train")
    test = t.filter(F.col("part") == "test")
    spec = spec or _spec()
    tr, te, _ = M.prepare(train, test, spec)
    return stored(tr, "train-part"), stored(te, "test-part"), spec


def _scored(est_fn, spark, d):
    tr, te, _ = _parts(spark, d)
    est = est_fn(tr)
    _, scored = M.fit_score(est, tr, te, "loan_id")
    return scored


@query("logistic")
def q_logistic(spark, d):
    """sklearn-default logistic regression (L2, C = 1): test-row scores."""
    return _scored(lambda tr: M.logistic("sklearn", n_train=tr.count()), spark, d)


# fixed values: tree counts of the original forests
FOREST_TREES, DUMMY_TREES, COMPARED_TREES = 1000, 300, 100


def _forest(trees: int = FOREST_TREES):
    """The original forest, fully grown."""
    return Forest(trees, seed=3)


@query("random_forest")
def q_random_forest(spark, d):
    return _scored(lambda tr: _forest(), spark, d)


@query("feature_importance")
def q_feature_importance(spark, d):
    tr, _, spec = _parts(spark, d)
    model = _forest().fit(tr)
    return model.importances(spec.names)


@query("gradient_boosting")
def q_gradient_boosting(spark, d):
    return _scored(lambda tr: M.gradient_boosting(max_iter=300, step_size=0.3, max_depth=1, seed=0), spark, d)


@query("decision_tree")
def q_decision_tree(spark, d):
    return _scored(lambda tr: Tree(seed=10), spark, d)


@query("linear_svm")
def q_linear_svm(spark, d):
    return _scored(lambda tr: M.linear_svm(), spark, d)


@query("gaussian_nb")
def q_gaussian_nb(spark, d):
    return _scored(lambda tr: M.gaussian_nb(), spark, d)


@query("ada_boost")
def q_ada_boost(spark, d):
    tr, te, _ = _parts(spark, d)
    model = M.ada_boost(tr, n_estimators=300, learning_rate=0.3)
    return model.transform(te).select("loan_id", M.LABEL, "score", "prediction")


STUMP_COLS, STUMP_ROUNDS, STUMP_RATE = ["apr", "dti"], 10, 0.3


def _stumps_sql() -> str:
    """Ten rounds: weights, both classes' running sums per column, the least error, the next weights."""
    sql = f", w0 AS (SELECT default_flag AS y, {', '.join(STUMP_COLS)}, 1.0::DOUBLE AS w FROM loan_tape WHERE " + \
        " AND ".join(f"{c} IS NOT NULL" for c in STUMP_COLS) + ")\n"
    for k in range(STUMP_ROUNDS):
        long = " UNION ALL ".join(f"SELECT {f} AS f, {c}::DOUBLE AS v, sum(w * y) AS p, sum(w * (1 - y)) AS n FROM w{k} GROUP BY {c}"
                                  for f, c in enumerate(STUMP_COLS))
        value = "CASE f " + " ".join(f"WHEN {f} THEN {c}" for f, c in enumerate(STUMP_COLS)) + " END"
        sql += f""", c{k} AS MATERIALIZED (SELECT f, v, sum(p) OVER run AS p, sum(n) OVER run AS n, sum(p) OVER (PARTITION BY f) AS tp,
          sum(n) OVER (PARTITION BY f) AS tn, lead(v) OVER (PARTITION BY f ORDER BY v) AS nxt FROM ({long}) WINDOW run AS (PARTITION BY f ORDER BY v)),
s{k} AS MATERIALIZED (SELECT f, v + (nxt - v) / 2 AS threshold, side, e / (tp + tn) AS err, {STUMP_RATE} * ln((tp + tn - e) / e) AS alpha FROM (
          SELECT *, 1 AS kind, 1 AS side, n + tp - p AS e FROM c{k} WHERE nxt IS NOT NULL
          UNION ALL SELECT *, 1 AS kind, 0 AS side, p + tn - n AS e FROM c{k} WHERE nxt IS NOT NULL
          -- the majority without a cut
          UNION ALL SELECT 0 AS f, NULL AS v, NULL AS p, NULL AS n, max(tp) AS tp, max(tn) AS tn, NULL AS nxt, 0 AS kind,
                           CAST(max(tp) > max(tn) AS INTEGER) AS side, least(max(tp), max(tn)) AS e FROM c{k} WHERE f = 0)
          ORDER BY round(e / (tp + tn), 11), kind, f, v, side DESC LIMIT 1),
w{k + 1} AS MATERIALIZED (SELECT y, {', '.join(STUMP_COLS)},
          w * CASE WHEN CASE WHEN threshold IS NULL OR {value} <= threshold THEN side ELSE 1 - side END = y THEN 1 ELSE exp(alpha) END
            / ((1 - err) + err * exp(alpha)) AS w FROM w{k}, s{k})
"""
    return sql + "\nUNION ALL\n".join(
        f"SELECT {k + 1} AS round, f AS feature, round(threshold, 6) AS threshold, CAST(side AS DOUBLE) AS left_class, round(err, 6) AS error, "
        f"round(alpha, 6) AS alpha FROM s{k}" for k in range(STUMP_ROUNDS))


@query("ada_boost_stumps", tape_sql(_stumps_sql()))
def q_ada_boost_stumps(spark, d):
    """The first ten stumps on two columns (complete rows): the best cut over all distinct values each round."""
    t = labelled_tape(spark, d).dropna(subset=STUMP_COLS)
    tr, _, _ = M.prepare(t, None, M.FeatureSpec(numeric=STUMP_COLS, categorical=[], label="default_flag", key="loan_id"))
    model = M.ada_boost(tr, n_estimators=STUMP_ROUNDS, learning_rate=STUMP_RATE)
    rows = [(k + 1, s.feature, s.threshold, s.left, s.error, s.alpha) for k, s in enumerate(model.stumps)]
    return spark.createDataFrame(rows, "round int, feature int, threshold double, left_class double, error double, alpha double")


NB_COLS = ["apr", "dti", "revolving_util", "fico"]


@query("gaussian_nb_stats", tape_sql(
    ", cc AS (SELECT * FROM loan_tape WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NB_COLS) + "),\n"
    # Gaussian naive Bayes adds 1e-9 x the largest feature variance to every variance
    "smooth AS (SELECT 1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in NB_COLS) + ") AS eps FROM cc)\n"
    + "\nUNION ALL\n".join(
        f"SELECT default_flag AS class, '{c}' AS feature, {r6('count(*) / (SELECT count(*) FROM cc)')} AS prior, "
        f"{r6(f'avg({c})')} AS mean, {r6(f'var_pop({c}) + (SELECT eps FROM smooth)')} AS variance "
        "FROM cc GROUP BY default_flag"
        for c in NB_COLS)))
def q_gaussian_nb_stats(spark, d):
    """Class priors, means and (population) variances of the fitted Gaussian naive Bayes model."""
    t = labelled_tape(spark, d).dropna(subset=NB_COLS)
    spec = M.FeatureSpec(numeric=NB_COLS, categorical=[], label="default_flag", key="loan_id")
    tr, _, _ = M.prepare(t, None, spec)
    model = M.gaussian_nb().fit(tr)
    return M.naive_bayes_stats(model, NB_COLS)


def _nb_sql(rows: str, models: str, used: str, scored: str) -> str:
    """CTEs ``nb_pred (model, loan_id, fold, label, prediction)``: Gaussian naive Bayes fitted on the ``rows``
    for which ``used`` holds and applied where ``scored`` holds, once for each model number ``m``."""
    stats = ", ".join(f"avg({c}) AS mean_{c}, var_pop({c}) AS var_{c}" for c in NB_COLS)
    log_density = " ".join(f"- 0.5::DOUBLE * ln(2 * pi() * (var_{c} + eps)) - (r.{c} - mean_{c}) ** 2 / (2 * (var_{c} + eps))"
                           for c in NB_COLS)
    return f""",
rw AS ({rows}),
mm AS (SELECT unnest({models}) AS m),
eps AS (SELECT m, 1e-9 * greatest({", ".join(f"var_pop({c})" for c in NB_COLS)}) AS eps, count(*) AS n
        FROM rw JOIN mm ON {used} GROUP BY m),
st AS (SELECT m, default_flag AS c, count(*) AS nc, {stats} FROM rw JOIN mm ON {used} GROUP BY m, default_flag),
ll AS (SELECT m, r.loan_id, r.fold, r.default_flag AS label, c,
              ln(nc / n) {log_density} AS l
       FROM rw r JOIN mm ON {scored} JOIN st USING (m) JOIN eps USING (m)),
nb_pred AS (SELECT m AS model, loan_id, fold, label, arg_max(c, l) AS prediction FROM ll GROUP BY ALL)
"""


NB_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in NB_COLS)


@query("gaussian_nb_predictions", tape_sql(
    _nb_sql(f"SELECT *, CAST({SPLIT_SQL} = 'test' AS INTEGER) AS fold FROM loan_tape WHERE {NB_COMPLETE}", "[1]", "fold <> m", "r.fold = m")
    + "SELECT loan_id, label, prediction FROM nb_pred"))
def q_gaussian_nb_predictions(spark, d):
    """Predicted class of every test row (complete rows, 20 % hash split)."""
    t = random_split(labelled_tape(spark, d).dropna(subset=NB_COLS), "loan_id", 0.2, seed=3)
    spec = M.FeatureSpec(numeric=NB_COLS, categorical=[], label="default_flag", key="loan_id")
    tr, te, _ = M.prepare(t.filter("part = 'train'"), t.filter("part = 'test'"), spec)
    _, scored = M.fit_score(M.gaussian_nb(), tr, te, "loan_id")
    return scored.select("loan_id", F.col(M.LABEL).cast("int").alias("label"), "prediction")


# model -1 is fitted and scored on all rows, model k on all folds but k
@query("classification_scores_nb", tape_sql(
    _nb_sql(f"SELECT *, CAST({hash_sql(repr('0'))} % 3 AS INTEGER) AS fold FROM loan_tape WHERE {NB_COMPLETE}",
            "[-1, 0, 1, 2]", "fold <> m", "m = -1 OR r.fold = m")
    + """, cells AS (SELECT fold, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
                   count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                   count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
                   count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn
            FROM nb_pred WHERE model >= 0 GROUP BY GROUPING SETS ((fold), ())),
-- the area under the curve of hard labels is the mean of both classes' recalls
f AS (SELECT *, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc, (tp + tn) / (tp + fp + fn + tn) AS acc,
             greatest(tp + fn, tn + fp) / (tp + fp + fn + tn) AS base FROM cells)
SELECT 'gaussian_nb' AS model,
       round((SELECT avg(CAST(label = prediction AS INTEGER)) FROM nb_pred WHERE model = -1), 6) AS train_accuracy,
       round(a.auc, 6) AS auc_hard, a.tp, a.fp, a.fn, a.tn,
       round((SELECT avg(auc) FROM f WHERE fold IS NOT NULL), 6) AS mean_fold_auc,
       round((SELECT avg(acc) FROM f WHERE fold IS NOT NULL), 6) AS mean_fold_accuracy,
       round((SELECT avg(base) FROM f WHERE fold IS NOT NULL), 6) AS mean_baseline
FROM f a WHERE a.fold IS NULL"""))
def q_classification_scores_nb(spark, d):
    """Cross-validated scores of Gaussian naive Bayes (complete rows, 3 hashed folds)."""
    spec = M.FeatureSpec(numeric=NB_COLS, categorical=[], label="default_flag", key="loan_id")
    data, _, _ = M.prepare(labelled_tape(spark, d).dropna(subset=NB_COLS), None, spec)
    return T.classification_scores(M.gaussian_nb(), data, "loan_id", folds=3, seed=0, name="gaussian_nb")[0]


DUMMIES = {"dummy_grade": "grade IN ('2', '3', '5')", "dummy_purpose": "purpose IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')",
           "dummy_modflag": "modified_flag = false", "dummy_inq6mo": "inquiries_6m <= 0", "dmy_all": ALL_SQL}


@query("logistic_dummies", tape_sql("\nUNION ALL\n".join(
    f"SELECT '{name}' AS dummy, coalesce(CAST({rule} AS INTEGER), 0) AS value, {r6('avg(default_flag)', 5)} AS score "
    "FROM loan_tape GROUP BY ALL" for name, rule in DUMMIES.items())), round_digits=5)
def q_logistic_dummies(spark, d):
    """Unpenalised logistic fits on one criteria dummy each: the fitted probability per dummy value (the class rate)."""
    crit = {name: F.expr(rule) for name, rule in DUMMIES.items()}
    tape = stored(criteria_dummies(labelled_tape(spark, d), crit, None).select("loan_id", "default_flag", *DUMMIES), "dummy-tape")
    out = []
    for name in DUMMIES:
        data, _, _ = M.prepare(tape, None, M.FeatureSpec(numeric=[name], categorical=[], label="default_flag", key="loan_id"))
        # one row per (value, label) with its count as weight fits the same model
        data = stored(data.groupBy(M.FEATURES, M.LABEL).agg(F.count(F.lit(1)).cast("double").alias("weight")), "dummy-cells")
        model = M.logistic("none").setTol(1e-12).setWeightCol("weight").fit(data)
        cells = data.select(M.FEATURES).distinct()
        out.append(model.transform(cells).select(F.lit(name).alias("dummy"), vector_to_array(M.FEATURES)[0].cast("int").alias("value"),
                                                 M.score_column(model).alias("score")))
    return reduce(lambda a, b: a.unionByName(b), out)


KNN_SEED = 7


@query("knn_classify", f"""WITH e AS (SELECT vec_id, embedding, label,
                 CAST({hash_sql(repr(str(KNN_SEED)), 'vec_id')} AS DOUBLE) / 4294967296.0::DOUBLE < 0.2::DOUBLE AS is_test
          FROM embeddings),
q AS (SELECT * FROM e WHERE is_test), t AS (SELECT * FROM e WHERE NOT is_test),
d AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.label,
             list_sum(list_transform(range(1, len(q.embedding) + 1),
                                     lambda i: (q.embedding[i]::DOUBLE - t.embedding[i]::DOUBLE) ** 2)) AS dist
      FROM q, t),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM d),
v AS (SELECT qid, label, count(*) AS c FROM r WHERE rn <= 3 GROUP BY qid, label),
p AS (SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY c DESC, label) AS pr FROM v)
SELECT q.vec_id, q.label, p.label AS pred_label FROM q JOIN p ON q.vec_id = p.qid AND p.pr = 1""")
def q_knn_classify(spark, d):
    """Exact 3-NN vote on the embeddings (20 % hash test sample vs the rest)."""
    from tapewise.functions.exprs import hash_unit

    e = read_table(spark, d, "embeddings")
    is_test = hash_unit("vec_id", KNN_SEED) < F.lit(0.2)
    train = e.filter(~is_test)
    test = e.filter(is_test)
    pred = M.knn_classify(train, test, "vec_id", "embedding", "label", k=3)
    return test.select("vec_id", "label").join(pred, "vec_id")


@query("classification_scores")
def q_classification_scores(spark, d):
    """Cross-validated scores of the logistic model on the whole prepared tape (3 folds)."""
    data, _, _ = M.prepare(_model_tape(spark, d), None, _spec())
    data = stored(data, "prepared")
    est = M.logistic("sklearn", n_train=data.count())
    out, _ = T.classification_scores(est, data, "loan_id", folds=3, seed=0, name="logistic")
    return out


def _cv_scores(spark, d, estimator, name):
    data, _, _ = M.prepare(_model_tape(spark, d), None, _spec())
    return T.classification_scores(estimator, data, "loan_id", folds=3, seed=0, name=name)[0]


@query("classification_scores_forest")
def q_classification_scores_forest(spark, d):
    return _cv_scores(spark, d, _forest(), "random_forest")


@query("classification_scores_gbm")
def q_classification_scores_gbm(spark, d):
    return _cv_scores(spark, d, Boosted(rounds=300, depth=1, rate=0.3, min_rows=1), "gradient_boosting")


@query("classification_scores_ada_boost")
def q_classification_scores_ada_boost(spark, d):
    return _cv_scores(spark, d, M.AdaBoost(n_estimators=300, learning_rate=0.3), "ada_boost")


# ---------------------------------------------------------------- the portfolio study's five dummies

def _dummy_data(spark, d):
    tape = criteria_dummies(labelled_tape(spark, d), {name: F.expr(rule) for name, rule in DUMMIES.items()}, None)
    tape = stored(tape.select("loan_id", "default_flag", *DUMMIES), "dummy-tape")
    data, _, _ = M.prepare(tape, None, M.FeatureSpec(numeric=list(DUMMIES), categorical=[], label="default_flag", key="loan_id"))
    return data


_DUMMY_ROWS = ", dm AS (SELECT loan_id, default_flag AS label, CAST(" + hash_sql(repr("0")) + " % 3 AS INTEGER) AS fold, " + \
    " || ".join(f"CAST(coalesce(CAST({rule} AS INTEGER), 0) AS VARCHAR)" for rule in DUMMIES.values()) + " AS cell FROM loan_tape)\n"


def _scores_sql(name: str, predicted: str) -> str:
    """The scores' row from CTE ``predicted (model, fold, label, prediction)``; model -1 is fitted and scored on all rows."""
    return predicted + f""", cells AS (SELECT fold, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
       count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM predicted WHERE model >= 0 GROUP BY GROUPING SETS ((fold), ())),
f AS (SELECT *, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc, (tp + tn) / (tp + fp + fn + tn) AS acc,
             greatest(tp + fn, tn + fp) / (tp + fp + fn + tn) AS base FROM cells)
SELECT '{name}' AS model, round((SELECT avg(CAST(label = prediction AS INTEGER)) FROM predicted WHERE model = -1), 6) AS train_accuracy,
       round(a.auc, 6) AS auc_hard, a.tp, a.fp, a.fn, a.tn, round((SELECT avg(auc) FROM f WHERE fold IS NOT NULL), 6) AS mean_fold_auc,
       round((SELECT avg(acc) FROM f WHERE fold IS NOT NULL), 6) AS mean_fold_accuracy,
       round((SELECT avg(base) FROM f WHERE fold IS NOT NULL), 6) AS mean_baseline FROM f a WHERE a.fold IS NULL"""


# a fully grown tree gives every vector of dummies its class share
@query("decision_tree_dummies", tape_sql(_DUMMY_ROWS + f"SELECT loan_id, label, {r6('avg(label) OVER (PARTITION BY cell)')} AS score, "
                                         "CAST(avg(label) OVER (PARTITION BY cell) > 0.5 AS INTEGER) AS prediction FROM dm"))
def q_decision_tree_dummies(spark, d):
    """One fully grown tree on the five dummies."""
    data = _dummy_data(spark, d)
    _, scored = M.fit_score(Tree(seed=10), data, data, "loan_id")
    return scored.withColumn(M.LABEL, F.col(M.LABEL).cast("int"))


@query("classification_scores_tree_dummies", tape_sql(_DUMMY_ROWS + _scores_sql("decision_tree", """, m AS (SELECT unnest([-1, 0, 1, 2]) AS model),
share AS (SELECT model, cell, avg(label) AS p FROM dm JOIN m ON fold <> model GROUP BY model, cell),
predicted AS (SELECT model, fold, label, CAST(p > 0.5 AS INTEGER) AS prediction FROM dm JOIN m ON model = -1 OR fold = model JOIN share USING (model, cell))
""")))
def q_classification_scores_tree_dummies(spark, d):
    return T.classification_scores(Tree(seed=10), _dummy_data(spark, d), "loan_id", folds=3, seed=0, name="decision_tree")[0]


# neighbours depend on the row's vector of dummies only: per vector the three nearest training rows, least id first
@query("classification_scores_knn", tape_sql(_DUMMY_ROWS + _scores_sql("knn", """, m AS (SELECT unnest([-1, 0, 1, 2]) AS model),
v AS (SELECT DISTINCT cell FROM dm),
near AS (SELECT model, v.cell, label FROM v, m JOIN dm ON fold <> model
         QUALIFY row_number() OVER (PARTITION BY model, v.cell ORDER BY hamming(v.cell, dm.cell), loan_id) <= 3),
vote AS (SELECT model, cell, CAST(sum(label) >= 2 AS INTEGER) AS prediction FROM near GROUP BY ALL),
predicted AS (SELECT model, fold, label, prediction FROM dm JOIN m ON model = -1 OR fold = model JOIN vote USING (model, cell))
""")))
def q_classification_scores_knn(spark, d):
    """Cross-validated scores of 3 nearest neighbours on the five dummies."""
    return T.classification_scores(M.Knn(3), _dummy_data(spark, d), "loan_id", folds=3, seed=0, name="knn")[0]


@query("classification_scores_forest_dummies")
def q_classification_scores_forest_dummies(spark, d):
    return T.classification_scores(_forest(DUMMY_TREES), _dummy_data(spark, d), "loan_id", folds=3, seed=0, name="random_forest")[0]


@query("classification_scores_gbm_dummies")
def q_classification_scores_gbm_dummies(spark, d):
    est = Boosted(rounds=300, depth=1, rate=0.3, min_rows=1)
    return T.classification_scores(est, _dummy_data(spark, d), "loan_id", folds=3, seed=0, name="gradient_boosting")[0]


@query("classification_scores_svm")
def q_classification_scores_svm(spark, d):
    return _cv_scores(spark, d, M.linear_svm(), "linear_svm")


# fixed values: the original depth sweep
DEPTHS = list(range(1, 51))


@query("sweep")
def q_sweep(spark, d):
    tr, te, _ = _parts(spark, d)
    return T.sweep(tr, te, "max_depth", DEPTHS, "loan_id")


def tuning_grids(n_features: int) -> dict:
    """The original four grids: 100, 50, 50 and p - 1 values."""
    return {
        "min_samples_split": [float(v) for v in np.linspace(0.01, 1, 100)],
        "min_samples_leaf": [float(v) for v in np.linspace(0.01, 0.5, 50)],
        "max_depth": DEPTHS,
        "max_features": list(range(1, n_features)),
    }


@query("tune_and_refit")
def q_tune_and_refit(spark, d):
    tr, te, spec = _parts(spark, d)
    _, metrics = T.tune_and_refit(tr, te, tuning_grids(len(spec.names)), "loan_id")
    return metrics


@query("compare_models")
def q_compare_models(spark, d):
    """accuracy / precision / recall x (lr, dec, nb) on the test rows."""
    tr, te, _ = _parts(spark, d)
    tr = tr.persist()
    ests = {"lr": M.logistic("sklearn", n_train=tr.count()), "dec": Tree(seed=10),
            "nb": M.gaussian_nb()}
    longs = []
    for name, est in ests.items():
        _, s = M.fit_score(est, tr, te, "loan_id")
        st = C.accuracy_stats(s, M.LABEL, "prediction")
        longs.append(st.selectExpr(f"stack(3, 'accuracy', accuracy, 'precision', precision, 'recall', recall) AS (metric, value)")
                     .withColumn("model", F.lit(name)))
    allm = longs[0].unionByName(longs[1]).unionByName(longs[2])
    return C.compare_models(allm)


# fixed values: caret's default boosting grid, depths 1-3 by 50, 100 and 150 trees, with 10 rows a leaf and half the rows a round
GBM_GRID = [{"maxDepth": depth, "maxIter": trees} for depth in (1, 2, 3) for trees in (50, 100, 150)]
GBM = Boosted(rate=0.1, min_rows=10, share=0.5, seed=3)


def _comparison_models(n_train: int) -> dict:
    return {"random_forest": _forest(COMPARED_TREES),
            "logistic": M.logistic("none"),
            "gradient_boosting": TunedBoosted(GBM_GRID, GBM)}


@query("roc_comp")
def q_roc_comp(spark, d):
    tr, te, _ = _parts(spark, d, _formula_spec())
    tr = tr.persist()
    table, _ = T.roc_comp(tr, te, _comparison_models(tr.count()), "loan_id")
    return table


# fixed values: the nested feature lists of the comparison (full, top 8, top 6)
FEATURE_SETS = {
    "full": (NUMERIC, CATEGORICAL),
    "top8": (["apr", "fico", "inquiries_6m", "annual_income", "dti"], ["purpose", "home_ownership", "grade"]),
    "top6": (["apr", "fico", "inquiries_6m", "annual_income"], ["purpose", "grade"]),
}


@query("nested_feature_models")
def q_nested_feature_models(spark, d):
    t = random_split(_model_tape(spark, d), "loan_id", 0.2, seed=3)
    train = t.filter(F.col("part") == "train")
    test = t.filter(F.col("part") == "test")
    sets = {k: _spec(n, c, one_hot=True) for k, (n, c) in FEATURE_SETS.items()}
    return T.nested_feature_models(train, test, sets, _comparison_models, "loan_id")


# fixed values: the bucketed frame's nested lists (full, without the two weakest, without two more)
BUCKETED_SETS = {
    "full": (["apr", "fico"], ["inq6_bucket", "dti_bucket", "purpose", "home_ownership", "grade", "modified_flag"]),
    "top6": (["apr", "fico"], ["inq6_bucket", "dti_bucket", "purpose", "grade"]),
    "top4": (["apr", "fico"], ["inq6_bucket", "grade"]),
}


@query("bucketed_feature_models")
def q_bucketed_feature_models(spark, d):
    """The bucketed frame, missing levels as '999', through forest, logistic fit and tuned boosting: areas per feature set."""
    t = clean.cut_bins(labelled_tape(spark, d), "inquiries_6m", INQ_EDGES, out="inq6_bucket")
    t = clean.as_string(clean.cut_bins(t, "dti", DTI_EDGES, out="dti_bucket"), ["modified_flag"])
    levels = BUCKETED_SETS["full"][1]
    t = random_split(clean.fill_const(t, {c: "999" for c in levels}), "loan_id", 0.2, seed=3)
    t = stored(t.select("loan_id", "default_flag", "apr", "fico", *levels, "part"), "bucketed-frame")
    sets = {k: _spec(n, c, one_hot=True) for k, (n, c) in BUCKETED_SETS.items()}
    return T.nested_feature_models(t.filter("part = 'train'"), t.filter("part = 'test'"), sets, _comparison_models, "loan_id")


@query("gbm_repeated_cv")
def q_gbm_repeated_cv(spark, d):
    """Gradient boosting tuned by 4 x 4 repeated cross-validation on the training part."""
    tr, _, _ = _parts(spark, d, _formula_spec())
    return boosted_cv(tr, "loan_id", GBM_GRID, GBM)[0]


@query("card_study")
def q_card_study(spark, d):
    """The card study end to end: robust scaling, stratified split, three models, the tuned tree, and their scores.

    One row per model: accuracy, precision, recall, AUC of the hard labels and the anchored precision-recall area.
    """
    scaled = robust_scale(labelled_tape(spark, d), NUMERIC)
    t = stored(stratified_split(scaled, "loan_id", "default_flag", 0.2, seed=123), "card-study")
    tr, te, _ = M.prepare(t.filter("part = 'train'"), t.filter("part = 'test'"), _spec())
    tr, te = stored(tr, "card-train"), stored(te, "card-test")
    n, p = tr.count(), len(tr.first()[M.FEATURES])
    areas = stored(T.sweep_areas(tr, te, tuning_grids(p), "loan_id"), "card-sweeps")
    ests = {"dec": Tree(seed=10), "lr": M.logistic("sklearn", n_train=n), "nb": M.gaussian_nb(),
            "dec_tuned": T.tree_for(T.best_values(areas), n, "loan_id")}
    scored = stored(reduce(lambda a, b: a.unionByName(b), [
        M.fit_score(est, tr, te, "loan_id")[1].withColumn("model", F.lit(name)) for name, est in ests.items()]), "card-scores")
    stats = reduce(lambda a, b: a.unionByName(b), [
        C.accuracy_stats(scored.filter(F.col("model") == name), M.LABEL, "prediction").withColumn("model", F.lit(name)) for name in ests])
    hard = C.roc_auc(scored, M.LABEL, F.col("prediction"), by=["model"])
    area = C.pr_auc(scored, M.LABEL, "score", by=["model"]).select("model", F.col("pr_auc_one").alias("pr_auc"))
    return stats.join(hard, "model").join(area, "model").select("model", "accuracy", "precision", "recall", "auc_roc", "pr_auc")


@query("logistic_thresholds")
def q_logistic_thresholds(spark, d):
    """Logistic probabilities cut at 0.5 and 0.2: accuracy, precision, recall and hard-label AUC per threshold."""
    from tapewise.operators.clean import threshold_predict

    tr, te, _ = _parts(spark, d)
    _, scored = M.fit_score(M.logistic("sklearn", n_train=tr.count()), tr, te, "loan_id")
    outs = []
    for t in (0.5, 0.2):
        p = threshold_predict(scored, F.col("score"), t, out="pred_t")
        stats = C.accuracy_stats(p, M.LABEL, "pred_t")
        auc = C.roc_auc(p, M.LABEL, F.col("pred_t"))
        outs.append(stats.crossJoin(auc).withColumn("threshold", F.lit(t)))
    return outs[0].unionByName(outs[1])
