"""The steps that large tables need: work shared, packed, bounded or done once (findings of round 4)."""

import numpy as np
from test_scale_r03 import frame, names_of

from tapewise.functions import boost_kernel, tree_kernel
from tapewise.operators import boosting as B
from tapewise.operators import models as M
from tapewise.operators import trees as T


def test_ada_boost_of_rows_that_fit_a_task_is_one_task(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(400, 3)), 1)
    data = frame(spark, x, (x[:, 0] + rng.normal(size=400) > 0.3).astype(float))
    by_round = M.ada_boost(data, 25, 0.5, local_rows=1).stumps
    monkeypatch.setattr(M, "_dealt_values", None)
    whole = M.ada_boost(data, 25, 0.5).stumps
    assert [(s.feature, s.threshold, s.left, s.right) for s in whole] == [(s.feature, s.threshold, s.left, s.right) for s in by_round]
    assert np.allclose([(s.alpha, s.error) for s in whole], [(s.alpha, s.error) for s in by_round], atol=1e-9) and len(whole) == 25


def test_ada_boost_scores_by_a_shallow_sum(spark):
    stumps = [M.Stump(0, float(i), float(i % 2), 1.0 - i % 2, 1.0 + i) for i in range(400)]
    x = np.array([-1.0, 150.5, 500.0])
    want = sum(s.alpha * (2 * np.where(x <= s.threshold, s.left, s.right) - 1) for s in stumps) / sum(s.alpha for s in stumps)
    model = M.AdaBoostModel(stumps)
    assert max(np.cumsum([(c == "(") - (c == ")") for c in model.decision()._jc.toString()])) < 100
    found = model.transform(frame(spark, x[:, None], np.zeros(3))).orderBy("loan_id").collect()
    assert np.allclose([r.score for r in found], want) and [r.prediction for r in found] == [int(v > 0) for v in want]


def old_importances(model, p):
    total = np.zeros(p)
    for r in model.subtrees.collect():
        gain = tree_kernel.importances({k: np.asarray(r[k]) for k in T.KINDS}, p)
        total += gain / gain.sum()
    return total / len(model.plans)


def test_importances_read_no_nodes(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(300, 4)), 1)
    model = T.Forest(5, seed=2).fit(frame(spark, x, (x[:, 0] + 0.5 * x[:, 2] > 0).astype(float)))
    found = model.importances("abcd")
    assert "ReadSchema: struct<tree:int,gain:array<double>>" in found._jdf.queryExecution().executedPlan().toString()
    got = {r.feature: r.importance for r in found.collect()}
    assert np.allclose([got[c] for c in "abcd"], old_importances(model, 4))


def grown_directly(x, y, w, seed, m, min_leaf):
    """Node by node, each cut tried alone: leaves' (weight, share) by row."""
    out = np.zeros((len(y), 2))

    def grow(at, node):
        n, n1 = w[at].sum(), (w * y)[at].sum()
        best, found = None, 0
        if 0 < n1 < n and n >= 2 and n >= 2 * min_leaf:
            for f in tree_kernel.feature_order(np.array([node], np.uint64), seed, x.shape[1])[0]:
                values, cut = np.unique(x[at, f]), False
                for low, high in zip(values, values[1:]):
                    side = at & (x[:, f] <= low)
                    l, l1 = w[side].sum(), (w * y)[side].sum()
                    r, r1 = n - l, n1 - l1
                    if min(l, r) >= min_leaf:
                        cut, score = True, (l1 * l1 + (l - l1) * (l - l1)) / l + (r1 * r1 + (r - r1) * (r - r1)) / r
                        if best is None or (score, -f, -low) > best[:3]:
                            best = (score, -f, -low, side)
                found += cut
                if found == m:
                    break
        if best is None:
            out[at] = n, n1 / n
        else:
            grow(best[3], tree_kernel.child_ids(np.array([node], np.uint64), 0)[0])
            grow(at & ~best[3], tree_kernel.child_ids(np.array([node], np.uint64), 1)[0])

    grow(np.ones(len(y), bool), tree_kernel.ROOT)
    return out


def test_kernel_equals_direct_growth_for_all_kinds_of_weights():
    rng = np.random.default_rng(3)
    for case, weights in enumerate((np.ones(150), rng.integers(1, 5, 150), rng.integers(1, 90_000, 150), rng.random(150) + 0.1)):
        for m, min_leaf in ((2, 1.0), (5, 4.0)):
            x = np.round(rng.normal(size=(150, 5)), 1)
            x[:, 1], x[:, 2], x[:, 3] = 7.0, rng.integers(0, 2, 150), np.where(x[:, 3] > 1, np.inf, x[:, 3])
            y, w = rng.integers(0, 2, 150).astype(float), weights.astype("float64")
            tree = tree_kernel.grow(x, y, w, tree_kernel.ROOT, 0, case, m, min_leaf, 2.0, None)
            leaf = tree_kernel.leaves(tree, x)
            want = grown_directly(x, y, w, case, m, min_leaf)
            assert np.allclose(np.stack((tree["n"][leaf], tree["n1"][leaf] / tree["n"][leaf]), axis=1), want), (case, m)
            again = tree_kernel.grow(None, y, w, tree_kernel.ROOT, 0, case, m, min_leaf, 2.0, None, tree_kernel.value_codes(x),
                                     tree_kernel.values_of(x, tree_kernel.value_codes(x)))
            assert all((tree[k] == again[k]).all() for k in tree)


def test_kernel_keeps_one_leaf_where_all_features_are_constant():
    tree = tree_kernel.grow(np.ones((4, 3)), np.array([0.0, 1, 1, 0]), np.ones(4), tree_kernel.ROOT, 0, 1, 2, 1.0, 2.0, None)
    assert tree["feature"].tolist() == [-1] and tree["n"].tolist() == [4] and tree["n1"].tolist() == [2]


def dummies(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2, (n, 4)).astype(float)
    return x, (rng.random(n) < 0.2 + 0.5 * x[:, 1] * x[:, 2]).astype(float)


def test_large_tables_of_few_cells_grow_from_their_cells(spark, monkeypatch):
    x, y = dummies(400, 4)
    data, seen = frame(spark, x, y), names_of(monkeypatch, T)
    whole = {r.loan_id: r.score for r in T.Forest(12, seed=5).fit(data).mean_share(data).collect()}
    monkeypatch.setattr(T, "LOCAL_ROWS", 40)
    model = T.Forest(12, seed=5, local_rows=40).fit(data)
    found = model.mean_share(data).collect()
    assert "tree-active" not in seen and "tree-vectors" in seen and not model.levels
    assert len(found) == 400 and all(abs(r.score - whole[r.loan_id]) < 1e-12 for r in found)
    assert {r.loan_id: r.score for r in T.Tree(local_rows=40).fit(data).transform(data).collect()} == \
        {i: y[(x == x[i]).all(axis=1)].mean() for i in range(400)}


def test_boosting_takes_rows_alike_as_one(spark, monkeypatch):
    x, y = dummies(300, 6)
    data, seen, found = frame(spark, x, y), names_of(monkeypatch, B), []
    for local in (5, 1000):
        found.append([r.score for r in B.Boosted(6, 2, 0.3, 7, local_rows=local).fit(data).transform(data).orderBy("loan_id").collect()])
    assert seen.count("boost-alike") == 2
    monkeypatch.setattr(B, "_alike", lambda table: table)
    for local in (5, 1000):
        found.append([r.score for r in B.Boosted(6, 2, 0.3, 7, local_rows=local).fit(data).transform(data).orderBy("loan_id").collect()])
    assert all(np.allclose(f, found[0], atol=1e-12) for f in found)


def test_joined_features_give_each_features_sums():
    rng = np.random.default_rng(7)
    sizes = [2, 2, 1, 200, 5, 2, 256, 3]
    codes = np.stack([rng.integers(0, s, 3000) for s in sizes], axis=1).astype("u1")
    node, r = rng.integers(0, 4, 3000), rng.normal(size=3000)
    joint = boost_kernel.joined(codes, 256)
    assert len(joint) < len(sizes) and sorted(f for _, features, _ in joint for f in features) == list(range(len(sizes)))
    found = boost_kernel.joint_histogram(joint, len(sizes), node, 4, 256, [None, r])
    for f in range(len(sizes)):
        cell = node * 256 + codes[:, f]
        assert np.allclose(found[:, f, :, 0].ravel(), np.bincount(cell, minlength=1024))
        assert np.allclose(found[:, f, :, 1].ravel(), np.bincount(cell, r, 1024))
    assert not found[..., 2].any()
