"""NULL groups, NaN values, constant columns and numeric categories."""

import math

import pytest

from tapewise.operators import assoc, clean, curves, models, profile, split

NAN = float("nan")


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, None if i % 3 == 0 else "g", NAN if i == 7 else float(i)) for i in range(30)]
    return spark.createDataFrame(rows, "k long, g string, v double")


def test_null_groups_keep_their_rows(frame):
    got = {r["g"]: r for r in profile.describe_by(frame, ["v"], "g").collect()}
    assert got[None]["p50"] == 13.5 and got[None]["count"] == 10 and got["g"]["count"] == 19
    box = {r["g"]: r for r in profile.box_stats(frame, ["v"], "g").collect()}
    assert box[None]["n"] == 10
    assert sum(r["n"] for r in profile.histogram_by(frame, ["v"], "g").collect()) == 29
    assert split.stratified_split(frame, "k", "g").count() == 30


def test_nan_is_missing(spark, frame):
    r = profile.describe(frame, ["v"]).first()
    assert r["count"] == 29 and r["max"] == 29.0 and math.isfinite(r["mean"])
    scored = spark.createDataFrame([(1, NAN), (1, 0.9), (0, 0.1)], "y int, s double")
    assert curves.roc_auc(scored, "y", "s").first()[0] == 1.0


def test_label_encode_orders_numbers(spark):
    df = spark.createDataFrame([(2,), (10,), (9,), (None,)], "x int")
    assert {r["x"]: r["c"] for r in clean.label_encode(df.withColumnRenamed("x", "x0").selectExpr("x0 AS x", "x0 AS c"), ["c"]).collect()} == {
        2: 0, 9: 1, 10: 2, None: None}


def test_constant_column_has_no_bins(spark):
    df = spark.createDataFrame([(5.0, 1), (5.0, 0)], "x double, default_flag int")
    assert clean.equal_width_bins(df, "x", 4).count() == 0


def test_format_percent_of_null(spark):
    df = spark.createDataFrame([(None,), (0.5,)], "x double")
    assert [r["x_pct"] for r in clean.format_percent(df, "x").collect()] == [None, "50.00%"]


def test_small_p_values_do_not_vanish(spark):
    df = spark.createDataFrame([("f", 200.0, 3)], "field string, chi2 double, dof_ref int")
    assert 0 < assoc.add_chi2_pvalues(df).first()["p_value"] < 1e-40


def test_forest_depth_is_not_cut_silently():
    with pytest.raises(ValueError):
        models.random_forest(max_depth=31)
