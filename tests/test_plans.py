"""Plan-shape regressions: no cartesian products, filters and pruning reach the scan."""

import pytest
from conftest import SF001

from tapewise.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_scan_is_pruned_and_filtered(spark):
    df = QUERIES["filter_range"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the columns the tape needs are read from lineitem, never the text-like ones
    assert "l_shipdate" not in plan and "l_comment" not in plan
    read = QUERIES["read_tape"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderstatus:string>" in read


def test_range_filter_reaches_parquet_scan(spark):
    df = QUERIES["filter_amount_range"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,100000.0)" in plan


def test_small_selections_filter_without_an_exchange(spark):
    from tapewise.operators import clean
    from tapewise.operators import portfolio as PF

    rows = [(i, "a" if i % 3 else None, str(i % 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, f string, g string")
    sel = spark.createDataFrame([("f", "a"), ("g", "1"), ("g", "2"), ("other", "9"), ("g", None)], "field string, value string")
    want = {"all": {i for i, f, g in rows if f == "a" and g in ("1", "2")}, "any": {i for i, f, g in rows if f == "a" or g in ("1", "2")}}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("all", "any"):
            found = PF.portfolio_from_selection(df, sel, ["f", "g"], mode=mode)
            assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
            assert {r.k for r in found.collect()} == want[mode]
        found = clean.isin_filter(df, "g", sel.select("value"))
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_selections_join_with_the_same_rows(spark, monkeypatch):
    from tapewise.operators import clean
    from tapewise.operators import portfolio as PF

    df = spark.createDataFrame([(i, "hot" if i % 2 else str(i), i % 7) for i in range(300)], "k long, f string, g int")
    sel = spark.createDataFrame([("f", "hot"), ("f", "4"), ("g", "3"), ("g", "3")], "field string, value string")
    calls = [lambda: PF.portfolio_from_selection(df, sel, ["f", "g"], mode="all"), lambda: PF.portfolio_from_selection(df, sel, ["f", "g"], mode="any"),
             lambda: clean.isin_filter(df, "f", sel.select("value"))]
    small = [sorted(map(tuple, c().collect())) for c in calls]
    for module in (PF, clean):
        monkeypatch.setattr(module, "bounded_rows", lambda chosen: None)
    assert [sorted(map(tuple, c().collect())) for c in calls] == small and all(small)


def test_label_encode_ranks_any_type_without_a_global_window(spark):
    import datetime

    from tapewise.operators.clean import label_encode

    rows = [(i, f"v{i * 37 % 101:03d}", datetime.date(2020, 1, 1) + datetime.timedelta(days=i * 53 % 97), float(i * 7 % 11)) for i in range(300)]
    rows += [(300, None, None, None)]
    df = spark.createDataFrame(rows, "k long, s string, d date, x double")
    found = label_encode(df, ["s", "d", "x"], suffix="_code")
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
    for c in ("s", "d", "x"):
        codes = {v: i for i, v in enumerate(sorted({r[c] for r in found.collect()} - {None}))}
        assert all(r[f"{c}_code"] == codes.get(r[c]) for r in found.collect())


def test_csv_without_a_schema_is_an_error(spark, tmp_path):
    from tapewise.sources import read_tape

    with pytest.raises(ValueError):
        read_tape(spark, str(tmp_path), fmt="csv")
