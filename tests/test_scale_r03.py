"""The steps that large tables need: work shared, packed, bounded or done once (findings of round 3)."""

import numpy as np
import pandas as pd
from conftest import SF0001
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tapewise.functions import boost_kernel, knn_kernel, tree_kernel
from tapewise.operators import boosting as B
from tapewise.operators import models as M
from tapewise.operators import trees as T
from tapewise.plans import QUERIES


def frame(spark, x, y):
    rows = [(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "loan_id long, label double, x array<double>").select("loan_id", "label", array_to_vector("x").alias("features"))


def names_of(monkeypatch, module):
    seen, whole = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: seen.append(name) or whole(df, name))
    return seen


def test_draws_equal_sparks(spark):
    rows = spark.range(2000).select(F.xxhash64("id").alias("row"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("bootstrap"), F.lit(3), F.lit(7), "row"), 11).cast("double") / F.lit(float(1 << 53))
    want = rows.select("row", T._poisson(draw).alias("w")).toPandas()
    seed = T._bootstrap_seeds(spark, [T.TreePlan(7, 3, True)])[7]
    found = tree_kernel.xxhash64(want["row"].to_numpy(), seed) >> np.uint64(11)
    assert (tree_kernel.poisson(found.astype("float64") / float(1 << 53)) == want["w"]).all()


def test_tree_of_some_thousand_rows_takes_one_task(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(5000, 2)), rng.integers(0, 2, 5000)
    seen = names_of(monkeypatch, T)
    model = T.Tree().fit(frame(spark, x, y))
    assert "tree-active" not in seen and not model.levels


def test_rows_alike_grow_as_one(spark):
    x, y = np.array([[0, 1], [0, 1], [1, 0], [0, 1], [1, 0]] * 40, "float64"), np.array([0.0, 1, 1, 0, 1] * 40)
    cell = tree_kernel.alike(tree_kernel.value_codes(x), y)
    assert cell.max() == 2
    found = {r.loan_id % 5: r.score for r in T.Tree().fit(frame(spark, x, y)).mean_share(frame(spark, x, y)).collect()}
    assert np.allclose([found[i] for i in range(5)], [1 / 3, 1 / 3, 1, 1 / 3, 1])


def test_margins_are_kept(spark, monkeypatch):
    rng = np.random.default_rng(2)
    data = frame(spark, rng.normal(size=(120, 2)), rng.integers(0, 2, 120))
    monkeypatch.setattr(B, "STEP", 2)
    seen, found = names_of(monkeypatch, B), []
    for local in (1, 1000):
        found.append([r.score for r in B.Boosted(5, 2, 0.3, 5, local_rows=local).fit(data).transform(data).orderBy("loan_id").collect()])
    assert seen.count("boost-margins") == 3
    assert np.allclose(*found)


def test_histogram_equals_sums():
    rng = np.random.default_rng(3)
    codes, node, r = rng.integers(0, 4, (50, 3)), rng.integers(0, 2, 50), rng.random(50)
    found = boost_kernel.histogram(codes, node, 2, 4, r, r * r)
    own = (node == 1) & (codes[:, 2] == 3)
    assert np.allclose(found[1, 2, 3], [own.sum(), r[own].sum(), (r[own] ** 2).sum()])


def test_equal_vectors_are_asked_once(spark, monkeypatch):
    sizes, whole = {}, M.stored

    def counted(df, name):
        out = whole(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(M, "stored", counted)
    rows = spark.range(400).select("id", F.array((F.col("id") % 2).cast("double"), F.lit(0.0)).alias("v"), (F.col("id") % 3).cast("int").alias("label"))
    found = M.knn_classify(rows, rows, "id", "v", "label", k=3)
    # three nearest of an even id: 0, 2, 4 (labels 0, 2, 1); of an odd one: 1, 3, 5 (1, 0, 2)
    assert {r.pred_label for r in found.collect()} == {0} and found.count() == 400
    assert sizes == {"knn-train": 6, "knn-queries": 2}


def test_knn_kernel_equals_brute_force():
    rng = np.random.default_rng(4)
    for odd in (False, True):
        q, t = rng.integers(-2, 3, (40, 3)).astype(float), rng.integers(-2, 3, (60, 3)) + rng.choice([0, 0.1], (60, 3)) + 1e6
        q += 1e6
        if odd:
            t[5, 1] = np.inf
        qd = pd.DataFrame({"qid": range(40), "vec": list(q)})
        td = pd.DataFrame({"tid": range(100, 160), "vec": list(t), "label": 1})
        found = knn_kernel.local_topk(qd, td, 4)
        diff = q[:, None, :] - t[None, :, :]
        every = np.einsum("ijk,ijk->ij", diff, diff)
        for i in range(40):
            want = sorted(zip(every[i], range(100, 160)))[:4]
            own = found[found["qid"] == i]
            assert list(own["tid"]) == [k for _, k in want] and list(own["dist"]) == [v for v, _ in want]


def test_stump_rows_travel_as_blocks(spark):
    rng = np.random.default_rng(5)
    base = spark.createDataFrame([(i, float(i % 2), [float(v) for v in rng.normal(size=2)]) for i in range(300)], "row long, y double, x array<double>")
    dealt = M._dealt_values(base, *M._value_ranges(base, 2))
    assert {kind for _, kind in dealt.dtypes} == {"binary"}
    assert sum(len(r.v) // 8 for r in dealt.collect()) == 600


def test_scores_read_the_written_tape(spark):
    for name in ("logistic", "logistic_dummies"):
        assert not any("lineitem" in f for f in QUERIES[name](spark, SF0001).inputFiles())
