"""Classifiers: Spark ML pipelines plus the two the library builds itself.

* Feature preparation is a ``Pipeline`` (mean ``Imputer`` -> ``StringIndexer``
  -> ``VectorAssembler``) fitted on the training rows only.
* Logistic regression, random forest, gradient boosting, decision tree,
  linear SVM and Gaussian naive Bayes are the Spark ML estimators.
* AdaBoost (discrete SAMME) is boosted whole in one task while its rows fit one;
  beyond that it is a driver loop of weighted stumps over rows dealt once by ranges
  of values, each round one job without a shuffle.  The stumps are turned into one
  SQL expression for scoring.
* k-nearest-neighbours is an exact blocked join: train and query rows are
  hashed into blocks, each (query block, train block) pair meets in one
  ``cogroup`` task that keeps the k best candidates per query row, and a
  window per query row merges the candidates.  No task sees more than one
  block of each side and no all-pairs row is emitted.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewise.functions import knn_kernel, stump_kernel
from tapewise.functions.exprs import hash_bucket
from tapewise.operators.trees import LOCAL_ROWS, packed, unpacked
from tapewise.session import stored

# the kernels travel with the task, so workers need no installed package
for kernel in (knn_kernel, stump_kernel):
    cloudpickle.register_pickle_by_value(kernel)

FEATURES = "features"
LABEL = "label"


# ---------------------------------------------------------------- features

@dataclass
class FeatureSpec:
    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    label: str = "default_flag"
    key: str = "loan_id"
    one_hot: bool = False  # dummy-code categoricals (formula style) instead of integer codes
    names: list[str] = field(default_factory=list)

    def input_names(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def feature_pipeline(spec: FeatureSpec, out: str = FEATURES) -> Pipeline:
    """Mean-impute numerics, index categoricals (alphabetical, NULL/unseen -> own code), assemble.

    With ``spec.one_hot`` the indexed categoricals are dummy-coded, as a model
    formula expands factors: one column per observed level (the same column
    space as baseline coding, so the same fitted predictions) plus the
    indexer's slot for levels unseen in training, which is zero while
    fitting.  Otherwise they enter as integer codes (label-encoder style).
    """
    stages = []
    num_out = [f"__num_{c}" for c in spec.numeric]
    if spec.numeric:
        stages.append(Imputer(inputCols=[f"__raw_{c}" for c in spec.numeric], outputCols=num_out, strategy="mean"))
    cat_out = [f"__cat_{c}" for c in spec.categorical]
    if spec.categorical:
        stages.append(StringIndexer(inputCols=[f"__str_{c}" for c in spec.categorical], outputCols=cat_out,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    if spec.categorical and spec.one_hot:
        oh_out = [f"__oh_{c}" for c in spec.categorical]
        stages.append(OneHotEncoder(inputCols=cat_out, outputCols=oh_out, dropLast=True, handleInvalid="keep"))
        cat_out = oh_out
    stages.append(VectorAssembler(inputCols=[*num_out, *cat_out], outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)


def stage_inputs(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Cast inputs to the types the pipeline stages expect and add the double ``label``."""
    cols = {f"__raw_{c}": F.col(c).cast("double") for c in spec.numeric}
    cols.update({f"__str_{c}": F.coalesce(F.col(c).cast("string"), F.lit("__null__")) for c in spec.categorical})
    cols[LABEL] = F.col(spec.label).cast("double")
    return df.withColumns(cols)


def prepare(train: DataFrame, test: DataFrame | None, spec: FeatureSpec) -> tuple[DataFrame, DataFrame | None, PipelineModel]:
    """Fit feature preparation on ``train`` and apply it to both parts."""
    tr = stage_inputs(train, spec)
    model = feature_pipeline(spec).fit(tr)
    keep = [spec.key, LABEL, FEATURES]
    tr_out = model.transform(tr).select(*keep)
    te_out = model.transform(stage_inputs(test, spec)).select(*keep) if test is not None else None
    spec.names = spec.input_names()
    return tr_out, te_out, model


# ---------------------------------------------------------------- estimators

def logistic(reg: str | float = "sklearn", n_train: int | None = None, max_iter: int = 100) -> LogisticRegression:
    """``reg='sklearn'``: L2 with C = 1, i.e. regParam = 1/n on unstandardised features;
    ``reg='none'``: the unpenalised GLM fit."""
    if reg == "sklearn":
        if not n_train:
            raise ValueError("n_train is needed for the sklearn-equivalent penalty")
        return LogisticRegression(regParam=1.0 / n_train, elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    if reg == "none":
        return LogisticRegression(regParam=0.0, maxIter=max_iter)
    return LogisticRegression(regParam=float(reg), maxIter=max_iter)


def random_forest(num_trees: int = 100, max_depth: int = 10, seed: int = 0, **kw) -> RandomForestClassifier:
    if max_depth > 30:
        raise ValueError("Spark trees allow maxDepth <= 30")
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=seed, **kw)


def gradient_boosting(max_iter: int = 300, step_size: float = 0.3, max_depth: int = 1, seed: int = 0) -> GBTClassifier:
    return GBTClassifier(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth, seed=seed)


def decision_tree(seed: int = 10, **kw) -> DecisionTreeClassifier:
    if "maxDepth" in kw and kw["maxDepth"] > 30:
        raise ValueError("Spark trees allow maxDepth <= 30")
    return DecisionTreeClassifier(seed=seed, **kw)


def linear_svm(reg: float = 0.0, max_iter: int = 100) -> LinearSVC:
    return LinearSVC(regParam=reg, maxIter=max_iter)


def gaussian_nb() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian")


def score_column(model) -> Column:
    """Score for ranking: probability of class 1, or the class-1 margin for SVMs.

    The library's own models (trees, boosting, k-NN) give a ``score`` column themselves.
    """
    if not hasattr(model, "hasParam"):
        return F.col("score")
    if model.hasParam("probabilityCol"):
        return vector_to_array(F.col("probability"))[1]
    return vector_to_array(F.col("rawPrediction"))[1]


def fit_score(estimator, train: DataFrame, test: DataFrame, key: str = "loan_id"):
    """Fit on prepared ``train``; return (model, ``key, label, score, prediction`` on ``test``)."""
    model = estimator.fit(train)
    scored = model.transform(test)
    return model, scored.select(key, LABEL, score_column(model).alias("score"),
                                F.col("prediction").cast("int").alias("prediction"))


def feature_importance(model, names: Sequence[str]) -> DataFrame:
    """``feature, importance`` sorted descending (mean decrease in impurity, normalised)."""
    imp = model.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def naive_bayes_stats(model, names: Sequence[str]) -> DataFrame:
    """Class priors, per-feature means and variances of a fitted Gaussian naive Bayes model."""
    spark = SparkSession.getActiveSession()
    pi = model.pi.toArray()
    theta = model.theta.toArray()
    sigma = model.sigma.toArray()
    rows = []
    for ci in range(len(pi)):
        for fi, n in enumerate(names):
            rows.append((int(ci), n, float(math.exp(pi[ci])), float(theta[ci][fi]), float(sigma[ci][fi])))
    return spark.createDataFrame(rows, "class int, feature string, prior double, mean double, variance double")


# ---------------------------------------------------------------- AdaBoost

@dataclass
class Stump:
    feature: int
    threshold: float | None  # None: constant prediction ``left``
    left: float               # prediction when x <= threshold
    right: float
    alpha: float
    error: float = 0.0


def _stump_expr(s: Stump, arr: Column) -> Column:
    if s.threshold is None:
        pred = F.lit(s.left)
    else:
        pred = F.when(arr[s.feature] <= F.lit(s.threshold), F.lit(s.left)).otherwise(F.lit(s.right))
    return F.lit(s.alpha) * (F.lit(2.0) * pred - F.lit(1.0))


@dataclass
class AdaBoostModel:
    stumps: list[Stump]

    def decision(self, features: str = FEATURES) -> Column:
        arr = vector_to_array(F.col(features))
        total = sum(abs(s.alpha) for s in self.stumps) or 1.0
        terms = [_stump_expr(s, arr) for s in self.stumps] or [F.lit(0.0)]
        while len(terms) > 1:  # added in pairs: a sum as deep as the rounds can overflow the analyser's stack
            terms = [reduce(operator.add, terms[i:i + 2]) for i in range(0, len(terms), 2)]
        return terms[0] / F.lit(total)

    def transform(self, df: DataFrame, features: str = FEATURES) -> DataFrame:
        d = self.decision(features)
        return df.withColumn("score", d).withColumn("prediction", (F.col("score") > 0).cast("int"))


#: Ranges of values per feature, each a unit of the running sums.
STUMP_RANGES = 256
#: Errors that differ by less than this share of all weight are ties: the lower feature, then the lower value wins.
STUMP_SLACK = 1e-12

#: Columns of a block of dealt values.
STUMP_BLOCK = {"f": "<i4", "r": "<i4", "salt": "<i4", "v": "<f8", "y": "<f8"}

_MINIMA = ("f int, r int, salt int, first double, pos double, neg double, a double, a_value double, a_next double, "
           "b double, b_value double, b_next double")


def _value_ranges(base: DataFrame, p: int) -> tuple[list, list]:
    """Per feature the upper ends of its ranges, and into how many parts each range is dealt.

    A value that fills several quantiles gets a range of its own, which any number of tasks can sum.
    """
    at = [i / STUMP_RANGES for i in range(1, STUMP_RANGES)]
    found = base.agg(*[F.percentile_approx(F.col("x")[f], at, 10 * STUMP_RANGES).alias(f"q{f}") for f in range(p)]).first()
    ends, parts = [], []
    for f in range(p):
        values, times = np.unique(np.array(found[f], "float64"), return_counts=True)
        hot = values[times > 1]
        ends.append(np.unique(np.concatenate((values, np.nextafter(hot, -np.inf)))))
        dealt = np.ones(len(ends[-1]) + 1, "int64")
        dealt[np.searchsorted(ends[-1], hot)] = times[times > 1]
        parts.append(dealt)
    return ends, parts


def _dealt_values(base: DataFrame, ends: list, parts: list) -> DataFrame:
    """One row per row and feature, dealt by range of values and sorted inside; packed in order into blocks of bytes."""
    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            x, y, row = np.stack(pdf["x"]), pdf["y"].to_numpy(), pdf["row"].to_numpy()
            for f in range(x.shape[1]):
                r = np.searchsorted(ends[f], x[:, f], side="left")
                yield pd.DataFrame({"f": f, "r": r, "salt": row.view("uint64") % parts[f][r].astype("uint64"), "v": x[:, f], "y": y, "x": list(x)})

    rows = base.mapInPandas(run, "f int, r int, salt int, v double, y double, x array<double>")
    n = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "f", "r", "salt").sortWithinPartitions("f", "r", "salt", "v")

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                # features one after another, so that a round reads a column at a stretch
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1).T
                held = [*(batch.column(c).to_numpy().astype(kind) for c, kind in STUMP_BLOCK.items()), x.astype("<f8")]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in held], names=[*STUMP_BLOCK, "x"])

    return dealt.mapInArrow(pack, ", ".join(f"{c} binary" for c in (*STUMP_BLOCK, "x")))


def _best_stump(found: pd.DataFrame, n: float) -> tuple[float, int | None, float | None, float, float]:
    """(error weight, feature, threshold, left, right) from the ranges' minima; feature None predicts ``left`` always."""
    total = found[found["f"] == found["f"].min()]
    ones, zeros = float(total["pos"].sum()), float(total["neg"].sum())
    majority = 1.0 if ones > zeros else 0.0
    cuts = []
    for f, own in found.groupby("f"):
        # a range dealt to several tasks holds one value: its sums add up
        sums = own.groupby("r").agg(first=("first", "min"), pos=("pos", "sum"), neg=("neg", "sum"), tasks=("f", "size"))
        one = own.groupby("r")[["a", "a_value", "a_next", "b", "b_value", "b_next"]].first()
        before = np.concatenate(([0.0], np.cumsum((sums["neg"] - sums["pos"]).to_numpy())[:-1]))
        after = np.append(sums["first"].to_numpy()[1:], np.nan)
        several = sums["tasks"].to_numpy() > 1
        lead = (sums["neg"] - sums["pos"]).to_numpy()
        for name, sign, left in (("a", 1.0, 1.0), ("b", -1.0, 0.0)):
            least = np.where(several, sign * lead, one[name].to_numpy())
            low, high = one[f"{name}_value"].to_numpy(), one[f"{name}_next"].to_numpy()
            high = np.where(np.isnan(high) | several, after, high)
            error = (ones if left else zeros) + sign * before + least
            cuts += [(e, f, a, b, left) for e, a, b in zip(error, low, high) if not np.isnan(b)]
    slack = STUMP_SLACK * n
    best = min([c[0] for c in cuts], default=np.inf)
    if best >= min(ones, zeros) - slack:
        return min(ones, zeros), None, None, majority, majority
    e, f, a, b, left = min((c for c in cuts if c[0] <= best + slack), key=lambda c: (c[1], c[2], -c[4]))
    mid = a + (b - a) / 2
    return e, int(f), float(mid if mid < b else a), left, 1.0 - left


def _boosted_whole(base: DataFrame, p: int, n_estimators: int, learning_rate: float) -> AdaBoostModel:
    """All rounds in one task, over the packed rows."""
    def run(table):
        x, y = unpacked(table, "x", "<f8", p), unpacked(table, "y", "<f8")
        found = stump_kernel.boost(x, y, n_estimators, learning_rate, STUMP_SLACK)
        columns = [list(c) for c in zip(*found)] or [[] for _ in range(6)]
        kinds = (pa.int32(), *[pa.float64()] * 5)
        return pa.Table.from_arrays([pa.array(range(len(found)), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                    names=["round", "feature", "threshold", "left", "right", "alpha", "error"])

    schema = "round int, feature int, threshold double, left double, right double, alpha double, error double"
    blocks = packed(base.select("y", "x"), p).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(0))))
    found = blocks.groupBy("task").applyInArrow(run, schema).collect()  # one row per round
    return AdaBoostModel([Stump(r.feature, r.threshold, r.left, r.right, r.alpha, r.error) for r in sorted(found, key=lambda r: r["round"])])


def ada_boost(train: DataFrame, n_estimators: int = 300, learning_rate: float = 0.3, key: str = "loan_id",
              local_rows: int = LOCAL_ROWS) -> AdaBoostModel:
    """Discrete AdaBoost (SAMME, two classes) over weighted decision stumps, each the best of all cuts.

    Up to ``local_rows`` rows are boosted whole in one task.  Beyond that, the rows are dealt once by feature and range of values, sorted.  A round is one job without a shuffle: tasks
    compute the weights from the stumps so far (one step function per feature, so a round costs the same however many
    there are) and return, for each range, its class weights and the cuts where either class leads most.  Running
    sums over the ranges, a table bounded by features and ranges, give the errors and the stump.  A lost task is
    computed again from the rows; there are no weights to lose.
    """
    first = train.select(FEATURES).first()
    if first is None:
        return AdaBoostModel([])
    p = len(first[0])
    base = stored(train.select(F.xxhash64(key).alias("row"), F.col(LABEL).cast("double").alias("y"), vector_to_array(F.col(FEATURES)).alias("x")), "stump-rows")
    n = base.count()
    if n <= local_rows:
        return _boosted_whole(base, p, n_estimators, learning_rate)
    ends, parts = _value_ranges(base, p)
    data = _dealt_values(base, ends, parts).persist()
    stumps: list[Stump] = []
    scale = 0.0  # logarithm of what keeps the weights' sum at the row count
    while len(stumps) < n_estimators:
        constant, steps = stump_kernel.compiled([(s.feature if s.threshold is not None else None, s.threshold, s.left, s.right, s.alpha) for s in stumps], p)
        whole = sum(s.alpha for s in stumps)

        def run(batches, constant=constant, steps=steps, whole=whole, scale=scale):
            held = []
            for block in (b for batch in batches for b in batch.to_pylist()):
                f, r, salt, v, y = (np.frombuffer(block[c], kind) for c, kind in STUMP_BLOCK.items())
                x = np.frombuffer(block["x"], "<f8").reshape(-1, len(y)).T
                ones = stump_kernel.votes(x, constant, steps)
                w = np.exp(np.where(y > 0, whole - ones, ones) - scale)
                held.append(stump_kernel.cells(f, r, salt, v, w * y, w * (1 - y)))
            if held:
                joined = stump_kernel.cells(*(np.concatenate(c) for c in zip(*held)))
                yield pa.RecordBatch.from_pydict(stump_kernel.range_minima(*joined, STUMP_SLACK * n))

        found = data.mapInArrow(run, _MINIMA).toPandas()  # at most features x ranges x parts rows
        e_w, f, threshold, left, right = _best_stump(found, n)
        err = float(e_w) / n
        if err <= STUMP_SLACK or err >= 0.5:
            if not stumps or err <= STUMP_SLACK:
                stumps.append(Stump(f or 0, threshold, left, right, 1.0, err))
            break
        alpha = learning_rate * math.log((1.0 - err) / err)
        stumps.append(Stump(f or 0, threshold, left, right, alpha, err))
        scale += math.log((1.0 - err) + err * math.exp(alpha))
    data.unpersist()
    return AdaBoostModel(stumps)


@dataclass
class AdaBoost:
    """AdaBoost as an estimator."""

    n_estimators: int = 300
    learning_rate: float = 0.3
    key: str = "loan_id"
    local_rows: int = LOCAL_ROWS

    def fit(self, data: DataFrame) -> AdaBoostModel:
        return ada_boost(data, self.n_estimators, self.learning_rate, self.key, self.local_rows)


# ---------------------------------------------------------------- k nearest neighbours

def knn_classify(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int = 3,
                 block_rows: int = 4096, seed: int = 11) -> DataFrame:
    """Exact k-NN majority vote (squared Euclidean; ties by train key, votes tied -> smallest label).

    Equal vectors are asked once, and of equal training vectors the ``k`` with the least keys take part, as no others
    can be among the nearest.  Returns ``key, pred_label`` for every ``test`` row (NULL without training rows).  The two block counts
    come from two row counts (one number each) and bound every task to one
    block of each side.
    """
    least = Window.partitionBy("vec").orderBy("tid")
    tr = train.select(F.col(key).alias("tid"), F.col(vec).alias("vec"), F.col(label).cast("int").alias("label"))
    tr = stored(tr.withColumn("__rn", F.row_number().over(least)).filter(F.col("__rn") <= k).drop("__rn"), "knn-train")
    te = test.select(F.col(key).alias("qid"), F.col(vec).alias("vec")).filter("qid is not null")
    asked = stored(te.select("vec").distinct().withColumn("rep", F.monotonically_increasing_id()), "knn-queries")
    nb_t = max(1, math.ceil(tr.count() / block_rows))
    nb_q = max(1, math.ceil(asked.count() / block_rows))
    tr = tr.withColumn("tb", hash_bucket("tid", seed, nb_t)) \
           .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nb_q - 1))))
    blocks = asked.select(F.col("rep").alias("qid"), "vec").withColumn("qb", hash_bucket("qid", seed + 1, nb_q)) \
                  .withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(nb_t - 1))))
    kernel = knn_kernel.local_topk
    cand = blocks.groupBy("qb", "tb").cogroup(tr.groupBy("qb", "tb")).applyInPandas(
        lambda q, t: kernel(q, t, k), schema="qid long, tid long, dist double, label int")

    def nearest(found):
        w = Window.partitionBy("qid").orderBy("dist", "tid")
        return found.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")

    per_vec = nearest(cand).withColumnRenamed("qid", "rep").join(asked, "rep").select("vec", "tid", "dist", "label")
    top = nearest(te.join(per_vec, "vec").select("qid", "tid", "dist", "label"))
    votes = top.groupBy("qid", "label").agg(F.count(F.lit(1)).alias("__votes"))
    pick = Window.partitionBy("qid").orderBy(F.desc("__votes"), F.asc("label"))
    best = votes.withColumn("__p", F.row_number().over(pick)).filter(F.col("__p") == 1)
    found = best.select(F.col("qid").alias(key), F.col("label").alias("pred_label"))
    return test.select(key).join(found, key, "left")


@dataclass
class Knn:
    """k nearest neighbours as an estimator; the model is the training rows."""

    k: int = 3
    key: str = "loan_id"

    def fit(self, data: DataFrame) -> KnnModel:
        return KnnModel(self, data)


@dataclass
class KnnModel:
    est: Knn
    train: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and the same as ``score``."""
        key = self.est.key
        vectors = [d.withColumn("__vec", vector_to_array(F.col(FEATURES))) for d in (self.train, df)]
        found = knn_classify(*vectors, key, "__vec", LABEL, self.est.k)
        return df.join(found.select(key, F.col("pred_label").cast("double").alias("score"), F.col("pred_label").alias("prediction")), key)
