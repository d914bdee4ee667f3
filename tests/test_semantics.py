"""Hand-checked literal fixtures for the semantics settled in SURVEY §7.4, plus properties."""

import hashlib
import math

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tapewise.functions.exprs import cut_expr, hash_int, safe_log_expr
from tapewise.operators import assoc as A
from tapewise.operators import clean
from tapewise.operators import curves as C
from tapewise.operators import portfolio as PF
from tapewise.operators import profile as P
from tapewise.operators import returns as R
from tapewise.operators import split as S
from tapewise.sources.fixture import labelled_tape


def test_null_status_is_default(spark):
    df = spark.createDataFrame([(1, "Current"), (2, "Matured"), (3, "Charged Off"), (4, None)], "id int, status string")
    out = clean.default_label(df, "status", ["Current", "Matured"]).orderBy("id").collect()
    assert [r.default_flag for r in out] == [0, 0, 1, 1]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.15,), (0.1500001,), (0.21,), (0.3,), (None,)], "x double")
    got = [r[0] for r in df.select(cut_expr("x", [0, 0.15, 0.21])).collect()]
    assert got == [None, "(0,0.15]", "(0.15,0.21]", "(0.15,0.21]", None, None]


def test_log_zero_and_negative(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (math.e,), (None,)], "x double")
    got = [r[0] for r in df.select(safe_log_expr("x")).collect()]
    assert got[0] == 0.0 and got[1] is None and abs(got[2] - 1.0) < 1e-12 and got[3] is None


def test_floor_zero_and_fill(spark):
    df = spark.createDataFrame([(1, -5.0, None), (2, 0.0, 3.0), (3, 7.0, 5.0)], "id int, x double, y double")
    out = clean.fill_mean(clean.floor_zero(df, ["x"]), ["y"]).orderBy("id").collect()
    assert [r.x for r in out] == [0.0, 0.0, 7.0]
    assert [r.y for r in out] == [4.0, 3.0, 5.0]


def test_lump_rare_threshold_is_strict(spark):
    rows = [("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [("d",)]
    df = spark.createDataFrame(rows, "s string")
    out = clean.lump_rare(df, "s", 0.25, out="o").groupBy("o").count().collect()
    assert {r.o: r["count"] for r in out} == {"a": 3, "Other": 5}


def test_no_default_in_subset_gives_zero_rate(spark):
    df = spark.createDataFrame([(700.0, 0, 10.0), (710.0, 0, 12.0), (600.0, 1, 20.0), (650.0, 1, 18.0)],
                               "fico double, default_flag int, apr double")
    out = {r.field: r for r in R.def_adj_rets(df, ["fico"], ["fico"], 0.75).collect()}
    assert out["fico"].cutoff == pytest.approx(702.5)
    assert out["fico"].n == 1 and out["fico"].default_rate == 0.0 and out["fico"].def_adj_return == pytest.approx(12.0)
    assert out["All"].default_rate == 0.5 and out["All"].def_adj_return == pytest.approx(-35.0)


def test_zero_variance_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 0)], "x double, default_flag int")
    r = A.point_biserial(df, ["x"], style="py").first()
    assert r.r is None
    m = {(r.field_a, r.field_b): r.r for r in A.corr_matrix(df.withColumn("z", F.col("default_flag") * 2.0), ["x", "z"]).collect()}
    assert m[("x", "z")] is None and m[("x", "x")] is None and m[("z", "z")] == 1.0


CURVE_ROWS = [(0.9, 1), (0.8, 1), (0.8, 0), (0.5, 0), (0.3, 1), (0.1, 0)]


def test_tied_scores_auc_and_pr(spark):
    df = spark.createDataFrame(CURVE_ROWS, "s double, y int")
    assert C.roc_auc(df, "y", "s").first().auc_roc == pytest.approx(6.5 / 9)
    assert C.roc_auc(df, "y", 1 - F.col("s")).first().auc_roc == pytest.approx(1 - 6.5 / 9)
    assert C.average_precision(df, "y", "s").first().average_precision == pytest.approx(34 / 45)
    pr = C.pr_auc(df, "y", "s").first()
    assert pr.pr_auc_one == pytest.approx(143 / 180)
    assert pr.pr_auc_none == pytest.approx(83 / 180)
    assert pr.pr_auc_first == pytest.approx(143 / 180)


def test_curves_do_not_depend_on_range_count(spark):
    df = spark.createDataFrame(CURVE_ROWS * 7, "s double, y int")
    a = sorted(C.roc_curve(df, "y", "s", n_ranges=1).collect())
    b = sorted(C.roc_curve(df, "y", "s", n_ranges=3).collect())
    assert a == b
    rec = [r.recall for r in C.pr_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    assert rec == sorted(rec)


def test_all_labels_equal_auc_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "s double, y int")
    assert C.roc_auc(df, "y", "s").first().auc_roc is None


def test_grouped_auc_equals_separate(spark):
    df = spark.createDataFrame([(g, s, y) for g in ("a", "b") for s, y in CURVE_ROWS], "g string, s double, y int")
    got = {r.g: r.auc_roc for r in C.roc_auc(df, "y", "s", by=["g"]).collect()}
    assert got == {"a": pytest.approx(6.5 / 9), "b": pytest.approx(6.5 / 9)}


def test_select_alpha_ties_by_value(spark):
    rows = [("b", 0, 10.0)] * 2 + [("a", 0, 10.0)] * 2 + [("c", 1, 10.0)] * 4
    df = spark.createDataFrame(rows, "cat string, default_flag int, apr double")
    sel = R.select_alpha_values(df, ["cat"], share=0.2).collect()
    assert [r.value for r in sel] == ["a"]


def test_absent_level_has_null_mean(spark):
    df = spark.createDataFrame([("A", 700.0), ("B", 650.0)], "grade string, fico double")
    out = {r.grade: r.mean_fico for r in P.mean_by_ordered(df, "fico", "grade", ["AAA", "A", "B"]).collect()}
    assert out == {"AAA": None, "A": 700.0, "B": 650.0}


def test_equal_width_bins_exclude_minimum(spark):
    df = spark.createDataFrame([(float(v), v % 2) for v in range(13)], "x double, default_flag int")
    out = clean.equal_width_bins(df, "x", 4).orderBy("bin").collect()
    assert [r.n for r in out] == [3, 3, 3, 3]
    assert [(r.bin_lower, r.bin_upper) for r in out] == [(0.0, 3.0), (3.0, 6.0), (6.0, 9.0), (9.0, 12.0)]
    df2 = spark.createDataFrame([(float(v), 0) for v in range(11)], "x double, default_flag int")
    assert clean.equal_width_bins(df2, "x", 4).count() == 5  # step round-half-even(2.5) = 2


def test_cramers_v_yates_on_two_by_two(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 5 + [("b", 0)] * 5 + [("b", 1)] * 10
    df = spark.createDataFrame(rows, "c string, default_flag int")
    py = A.cramers_v(df, ["c"], style="py").first()
    assert py.chi2 == pytest.approx(10 / 3) and py.v_ref == pytest.approx(math.sqrt(10 / 3 / 30 / 2))
    assert py.v_std == pytest.approx(1 / 3) and py.dof_ref == 3 and py.dof_std == 1
    r = A.cramers_v(df, ["c"], style="r").first()
    assert r.chi2 == pytest.approx(32 / 15) and r.v == 0.189
    p = A.add_chi2_pvalues(A.cramers_v(df, ["c"], style="py"), "chi2", "dof_std").first()
    assert p.crit == pytest.approx(3.841459, abs=1e-5) and 0 < p.p_value < 0.1


def test_point_biserial_forms_agree(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (4.0, 1), (3.0, 1), (2.5, 0)], "x double, default_flag int")
    py = A.point_biserial(df, ["x"], style="py").first()
    rr = A.point_biserial(df, ["x"], style="r").first()
    assert rr.r_biserial == pytest.approx(-py.r * math.sqrt((5 - 1) / 5))
    assert A.add_t_pvalues(A.point_biserial(df, ["x"], style="py")).first().p_value < 0.2


def test_portfolio_all_within_any(spark):
    t = labelled_tape(spark, SF001)
    preds = [F.col("inquiries_6m") <= 0, F.col("fico") >= 707]
    all_ids = PF.portfolio_all(t, preds).select("loan_id")
    any_ids = PF.portfolio_any(t, preds).select("loan_id")
    assert all_ids.subtract(any_ids).count() == 0


def test_crosstab_margins_equal_totals(spark):
    t = labelled_tape(spark, SF001)
    ct = {(r.grade, r.default_flag): r.n for r in P.crosstab(t, "grade", "default_flag").collect()}
    assert ct[("All", "All")] == t.filter(F.col("grade").isNotNull()).count()
    assert ct[("All", "0")] + ct[("All", "1")] == ct[("All", "All")]


def test_shares_sum_to_one(spark):
    t = labelled_tape(spark, SF001)
    sums = P.share_by(t, ["grade", "home_ownership"]).groupBy("field").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)


def test_hash_matches_python_md5(spark):
    df = spark.createDataFrame([(k,) for k in (0, 1, 12345, 987654321)], "k long")
    got = [r[0] for r in df.select(hash_int("k", 3)).collect()]
    want = [int(hashlib.md5(f"3:{k}".encode()).hexdigest()[:8], 16) for k in (0, 1, 12345, 987654321)]
    assert got == want


def test_splits_are_disjoint_complete_and_exact(spark):
    t = labelled_tape(spark, SF001).select("loan_id", "default_flag")
    n = t.count()
    rs = S.random_split(t, "loan_id", 0.2, seed=3, exact=True)
    assert rs.count() == n and rs.filter(F.col("part") == "test").count() == math.floor(0.2 * n + 0.5)
    ss = S.stratified_split(t, "loan_id", "default_flag", 0.2, seed=123)
    per = {(r.default_flag, r.part): r["count"] for r in ss.groupBy("default_flag", "part").count().collect()}
    for lab in (0, 1):
        n_lab = per[(lab, "test")] + per[(lab, "train")]
        assert per[(lab, "test")] == math.floor(0.2 * n_lab + 0.5)
    kf = S.kfold(t, "loan_id", 4, seed=1, exact=True).groupBy("fold").count().collect()
    sizes = [r["count"] for r in kf]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    test = rs.filter(F.col("part") == "test")
    assert S.complement_split(t, test, "loan_id").count() == n - test.count()


def test_result_invariant_to_partitioning(spark):
    t = labelled_tape(spark, SF001)
    a = sorted(R.return_by_category(t.repartition(3), ["grade", "purpose"]).collect())
    b = sorted(R.return_by_category(t.repartition(11, "loan_id"), ["grade", "purpose"]).collect())
    assert [(x.field, x.value, x.freq) for x in a] == [(x.field, x.value, x.freq) for x in b]
    for x, y in zip(a, b):
        assert x.def_adj_return == pytest.approx(y.def_adj_return, abs=1e-9)


def test_control_values_sf001(spark):
    """Values recorded in FIXTURES §4 for the sf0.01 tape."""
    t = labelled_tape(spark, SF001)
    scored = t.filter(F.col("apr").isNotNull())
    assert scored.count() == 14743
    assert scored.select("apr").distinct().count() == 297
    assert C.roc_auc(scored, "default_flag", "apr").first().auc_roc == pytest.approx(0.50075028225, abs=1e-10)
    pr = C.pr_auc(scored, "default_flag", "apr").first()
    assert pr.pr_auc_one == pytest.approx(0.34025970968, abs=1e-10)
    assert pr.pr_auc_none == pytest.approx(0.34013470968, abs=1e-10)
    assert pr.pr_auc_first == pytest.approx(0.34018470968, abs=1e-10)
    cv = {r.field: r for r in A.cramers_v(t, ["grade"], style="py").collect()}
    assert cv["grade"].chi2 == pytest.approx(2.5047639, abs=1e-7)
    assert cv["grade"].v_ref == pytest.approx(0.0091374, abs=1e-7)
    assert t.agg(F.avg("default_flag")).first()[0] == pytest.approx(0.3392, abs=1e-4)


def test_quantiles_with_a_hot_value_match_numpy(spark):
    """One value holds a third of the rows; exact quantiles still equal linear interpolation."""
    import numpy as np

    from tapewise.operators.quantiles import quantiles

    rng = np.random.default_rng(5)
    vals = np.concatenate([np.full(3000, 42.0), rng.normal(40, 10, 6000).round(3)])
    rows = [("a", float(v)) for v in vals] + [("b", float(v)) for v in vals[::7]]
    df = spark.createDataFrame(rows, "field string, value double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.field: r for r in quantiles(df, ["field"], "value", probs, n_ranges=16, map_limit=10).collect()}
    for f, arr in (("a", vals), ("b", vals[::7])):
        want = np.quantile(arr, probs)
        assert got[f].n == len(arr)
        for i, w in enumerate(want):
            assert got[f][f"q{i}"] == pytest.approx(w, abs=1e-9)


def test_curve_with_a_hot_score(spark):
    """A third of the rows share one score; AUC equals the Mann-Whitney count."""
    rows = [(0.5, i % 2) for i in range(300)] + [(i / 1000.0, 1 if i % 3 else 0) for i in range(600)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(4)
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert C.roc_auc(df, "y", "s", n_ranges=8).first().auc_roc == pytest.approx(wins / (len(pos) * len(neg)))


def test_quantile_paths_agree(spark):
    """The bounded-map path and the distributed path give the same exact quantiles."""
    import numpy as np

    from tapewise.operators.quantiles import quantiles

    rng = np.random.default_rng(11)
    vals = rng.lognormal(3, 1.5, 4000).round(4)
    df = spark.createDataFrame([("x", float(v)) for v in vals], "field string, value double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    small = quantiles(df, ["field"], "value", probs).first()
    dist = quantiles(df, ["field"], "value", probs, map_limit=10, n_ranges=32).first()
    want = np.quantile(vals, probs)
    for i, w in enumerate(want):
        assert small[f"q{i}"] == pytest.approx(w, abs=1e-9)
        assert dist[f"q{i}"] == pytest.approx(w, abs=1e-9)


def test_portfolio_from_selection_modes(spark):
    t = labelled_tape(spark, SF001)
    sel = spark.createDataFrame([("grade", "1"), ("grade", "2"), ("purpose", "BUILDING")], "field string, value string")
    all_df = PF.portfolio_from_selection(t, sel, ["grade", "purpose"], mode="all")
    any_df = PF.portfolio_from_selection(t, sel, ["grade", "purpose"], mode="any")
    g = F.col("grade").isin("1", "2")
    p = F.col("purpose") == "BUILDING"
    assert all_df.count() == t.filter(g & p).count()
    assert any_df.count() == t.filter(g | p).count()
    assert any_df.columns == t.columns


def test_edit_criteria_and_union_dedup(spark):
    crit = {"Grade": ["A", "B"], "State": ["CA"], "Home": ["OWN"]}
    out = PF.edit_criteria(crit, drop=["Home"], override={"Grade": ["B", "C", "E"]})
    assert out == {"Grade": ["B", "C", "E"], "State": ["CA"]}
    t = labelled_tape(spark, SF001).select("loan_id", "grade", "purpose")
    parts = [t.filter(F.col("grade") == "1"), t.filter(F.col("purpose") == "BUILDING"), t.filter(F.col("grade") == "1")]
    u = PF.union_dedup(parts)
    assert u.count() == u.select("loan_id").distinct().count() == t.filter(
        (F.col("grade") == "1") | (F.col("purpose") == "BUILDING")).count()
    a, b = (spark.createDataFrame(r, "loan_id long, grade string") for r in ([(1, "A"), (2, None)], [(1, "B"), (2, None)]))
    assert sorted(map(tuple, PF.union_dedup([a, b]).collect()), key=str) == [(1, "A"), (1, "B"), (2, None)]


def test_origin_point_is_dropped_as_undefined(spark):
    df = spark.createDataFrame(CURVE_ROWS, "s double, y int")
    curve = C.pr_curve(df, "y", "s")
    full = C.with_origin(curve)
    assert full.count() == curve.count() + 1
    assert full.filter(F.col("precision").isNull()).first().recall == 0.0
    assert sorted(C.curve_drop_na(full, "precision").collect()) == sorted(curve.collect())


def test_map_values_dataframe_and_dict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "id int, c string")
    m = spark.createDataFrame([("a", 10), ("b", 20), ("b", 20)], "k string, v int")
    got = {r.id: r.c_code for r in clean.map_values(df, "c", m).collect()}
    assert got == {1: 10, 2: 20, 3: None}
    got2 = {r.id: r.c_code for r in clean.map_values(df, "c", {"a": 10, "b": 20}).collect()}
    assert got2 == got


def test_select_alpha_values_ranged_equals_single(spark):
    t = labelled_tape(spark, SF001)
    cols = ["grade", "purpose", "state", "home_ownership"]
    a = sorted(R.select_alpha_values(t, cols, share=0.3).collect())
    b = sorted(R.select_alpha_values(t, cols, share=0.3, n_ranges=4).collect())
    assert a == b and len(a) > 0
