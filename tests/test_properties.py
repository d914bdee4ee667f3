"""Property checks: conservation, invariances, random-label behaviour, brute-force agreement."""

import numpy as np
import pytest
from conftest import SF001
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapewise.operators import curves as C
from tapewise.operators import models as M
from tapewise.operators import profile as P
from tapewise.operators.quantiles import quantiles
from tapewise.operators.split import random_split
from tapewise.sources.fixture import labelled_tape

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_value_counts_conserve_rows(spark):
    t = labelled_tape(spark, SF001)
    n = t.count()
    per = P.value_counts(t, ["grade", "home_ownership", "state"]).groupBy("field").agg(F.sum("n").alias("s")).collect()
    assert all(r.s == n for r in per)


def test_random_label_gives_chance_auc(spark):
    t = random_split(labelled_tape(spark, SF001), "loan_id", 0.2, seed=3)
    spec = M.FeatureSpec(numeric=["apr", "fico", "dti"], categorical=["grade"], label="default_flag", key="loan_id")
    tr, te, _ = M.prepare(t.filter(F.col("part") == "train"), t.filter(F.col("part") == "test"), spec)
    _, scored = M.fit_score(M.random_forest(num_trees=20, max_depth=5, seed=1), tr, te)
    auc = C.roc_auc(scored, M.LABEL, "score").first().auc_roc
    assert 0.45 < auc < 0.55


@SETTINGS
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
       st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=5))
def test_distributed_quantiles_match_numpy(spark, values, probs):
    df = spark.createDataFrame([("f", float(v)) for v in values], "field string, value double")
    got = quantiles(df, ["field"], "value", probs, map_limit=0, n_ranges=8).first()
    want = np.quantile(np.array(values, dtype=float), probs)
    for i, w in enumerate(want):
        assert got[f"q{i}"] == pytest.approx(w, abs=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=20), st.booleans()), min_size=2, max_size=200))
def test_auc_matches_mann_whitney(spark, pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    df = spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "s double, y int")
    got = C.roc_auc(df, "y", "s", n_ranges=4).first().auc_roc
    if not pos or not neg:
        assert got is None
    else:
        wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
        assert got == pytest.approx(wins / (len(pos) * len(neg)))


@pytest.mark.parametrize("n_cuts", [5, 31, 255, 1500])
def test_multi_level_search_equals_bisect(spark, n_cuts):
    """count_below over 1, 2 and 3 search levels equals a binary search."""
    import bisect

    from tapewise.operators.ranges import _levels, count_below

    rng = np.random.default_rng(n_cuts)
    cuts = sorted(rng.normal(0, 1, n_cuts).round(2).tolist())  # rounded: ties among cuts
    vals = rng.normal(0, 1.2, 400).round(2).tolist() + cuts[:20]
    levels = _levels(cuts)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    lv = [F.array(*[F.lit(float(c)) for c in arr]).cast("array<double>") for arr in levels]
    got = [r[0] for r in df.select(count_below(F.col("v"), lv)).collect()]
    assert got == [bisect.bisect_left(cuts, v) for v in vals]


def test_curves_by_group_with_forced_ranges(spark):
    rows = [(g, (i * 37 % 101) / 101.0, (i * 7) % 3 == 0) for g in ("a", "b") for i in range(300)]
    df = spark.createDataFrame([(g, s, int(y)) for g, s, y in rows], "g string, s double, y int")
    one = {r.g: r.auc_roc for r in C.roc_auc(df, "y", "s", n_ranges=1, by=["g"]).collect()}
    many = {r.g: r.auc_roc for r in C.roc_auc(df, "y", "s", n_ranges=9, by=["g"]).collect()}
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k]) for k in one)


def test_null_group_keys_survive_both_quantile_paths(spark):
    rows = [(None if i % 5 == 0 else "a", float(i % 37)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, value double").withColumn("field", F.lit("x"))
    fast = {r.g: (r.n, r.q0) for r in quantiles(df, ["field", "g"], "value", [0.5]).collect()}
    dist = {r.g: (r.n, r.q0) for r in quantiles(df, ["field", "g"], "value", [0.5], map_limit=0, n_ranges=4).collect()}
    assert fast == dist and None in fast and fast[None][0] == 100
    c = spark.createDataFrame([(None if i % 4 == 0 else "m", (i * 13 % 29) / 29.0, i % 2) for i in range(200)],
                              "g string, s double, y int")
    a1 = {r.g: r.auc_roc for r in C.roc_auc(c, "y", "s", by=["g"]).collect()}
    a2 = {r.g: r.auc_roc for r in C.roc_auc(c, "y", "s", by=["g"], n_ranges=5).collect()}
    assert a1.keys() == a2.keys() == {None, "m"} and all(a1[k] == pytest.approx(a2[k]) for k in a1)
