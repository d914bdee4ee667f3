"""Registered queries: tape preparation (labels, missing values, flags, bins, recodes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewise.operators import clean
from tapewise.operators.profile import default_rate_by
from tapewise.plans.registry import query, r6, tape_sql
from tapewise.sources.fixture import labelled_tape, read_table

TAPE_COLUMNS = [
    ("loan_id", "n"), ("status", "s"), ("grade", "s"), ("purpose", "s"), ("state", "s"), ("term_months", "n"),
    ("loan_amount", "n"), ("origination_date", "n"), ("charged_off_date", "n"), ("apr", "n"), ("dti", "n"),
    ("inquiries_6m", "n"), ("revolving_balance", "n"), ("revolving_util", "n"), ("modified_flag", "n"),
    ("annual_income", "n"), ("fico", "n"), ("home_ownership", "s"), ("default_flag", "n"),
]


@query("default_label", tape_sql("SELECT loan_id, status, default_flag FROM loan_tape"))
def q_default_label(spark, d):
    return labelled_tape(spark, d).select("loan_id", "status", "default_flag")


def _missing_sql() -> str:
    parts = []
    for c, kind in TAPE_COLUMNS:
        cond = f"{c} IS NULL" + (f" OR {c} = ''" if kind == "s" else "")
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {cond}) AS n_missing, count(*) AS n_rows FROM loan_tape")
    body = "\nUNION ALL\n".join(parts)
    return tape_sql(f""", m AS ({body})
SELECT column_name, n_missing, {r6('n_missing / n_rows')} AS missing_frac, n_missing < 0.70::DOUBLE * n_rows AS kept FROM m""")


@query("drop_sparse_columns", _missing_sql())
def q_drop_sparse_columns(spark, d):
    """The column report that ``drop_sparse_columns`` acts on (charged_off_date is dropped)."""
    return clean.sparse_column_report(labelled_tape(spark, d), 0.70)


@query("fill_const", tape_sql("SELECT loan_id, coalesce(home_ownership, 'none') AS home_ownership FROM loan_tape"))
def q_fill_const(spark, d):
    return clean.fill_const(labelled_tape(spark, d), {"home_ownership": "none"}).select("loan_id", "home_ownership")


@query("fill_mean", tape_sql(
    f"SELECT loan_id, {r6('coalesce(CAST(fico AS DOUBLE), (SELECT avg(fico) FROM loan_tape))')} AS fico FROM loan_tape"))
def q_fill_mean(spark, d):
    return clean.fill_mean(labelled_tape(spark, d), ["fico"]).select("loan_id", "fico")


@query("drop_incomplete", tape_sql(
    "SELECT loan_id, apr, fico, home_ownership FROM loan_tape "
    "WHERE apr IS NOT NULL AND fico IS NOT NULL AND home_ownership IS NOT NULL"))
def q_drop_incomplete(spark, d):
    t = clean.drop_incomplete(labelled_tape(spark, d), ["apr", "fico", "home_ownership"])
    return t.select("loan_id", "apr", "fico", "home_ownership")


_BLANKED = "CASE WHEN home_ownership IS NULL AND loan_id % 2 = 0 THEN '' ELSE home_ownership END"


@query("filter_not_blank", tape_sql(
    f""", b AS (SELECT loan_id, {_BLANKED} AS home_ownership FROM loan_tape)
SELECT loan_id, home_ownership FROM b WHERE home_ownership IS NULL OR home_ownership <> ''"""))
def q_filter_not_blank(spark, d):
    """A CSV-style tape where half the missing values are blanks: blanks go, NULLs stay."""
    t = labelled_tape(spark, d)
    t = t.withColumn("home_ownership", F.when(F.col("home_ownership").isNull() & (F.col("loan_id") % 2 == 0), F.lit(""))
                     .otherwise(F.col("home_ownership")))
    return clean.filter_not_blank(t, "home_ownership").select("loan_id", "home_ownership")


@query("isin_filter", tape_sql("SELECT loan_id, grade FROM loan_tape WHERE grade IN ('2', '3', '5')"))
def q_isin_filter(spark, d):
    return clean.isin_filter(labelled_tape(spark, d), "grade", ["2", "3", "5"]).select("loan_id", "grade")


@query("one_hot_flags", tape_sql(
    """SELECT loan_id,
  coalesce(CAST(term_months = 60 AS INTEGER), 0) AS term_60,
  coalesce(CAST(grade = '1' AS INTEGER), 0) AS grade_1,
  coalesce(CAST(home_ownership = 'OWN' AS INTEGER), 0) AS own_home
FROM loan_tape"""))
def q_one_hot_flags(spark, d):
    spec = {"term_60": ("term_months", 60), "grade_1": ("grade", "1"), "own_home": ("home_ownership", "OWN")}
    return clean.one_hot_flags(labelled_tape(spark, d), spec).select("loan_id", *spec)


@query("floor_zero", tape_sql(
    "SELECT loan_id, CASE WHEN annual_income <= 0 THEN 0 ELSE annual_income END AS annual_income FROM loan_tape"))
def q_floor_zero(spark, d):
    return clean.floor_zero(labelled_tape(spark, d), ["annual_income"]).select("loan_id", "annual_income")


def _log_sql(c: str) -> str:
    return r6(f"CASE WHEN {c} > 0 THEN ln({c}) WHEN {c} = 0 THEN 0.0::DOUBLE END") + f" AS log_{c}"


_LOG_COLS = ["annual_income", "revolving_balance", "inquiries_6m"]


@query("log_append", tape_sql("SELECT loan_id, " + ", ".join(_log_sql(c) for c in _LOG_COLS) + " FROM loan_tape"))
def q_log_append(spark, d):
    t = clean.log_append(labelled_tape(spark, d), _LOG_COLS)
    return t.select("loan_id", *[f"log_{c}" for c in _LOG_COLS])


_ENC_COLS = ["grade", "purpose", "state", "home_ownership"]


def _label_encode_sql() -> str:
    ctes = []
    joins = []
    sel = []
    for i, c in enumerate(_ENC_COLS):
        ctes.append(f"e{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
                    f"FROM (SELECT DISTINCT {c} AS v FROM loan_tape WHERE {c} IS NOT NULL))")
        joins.append(f"LEFT JOIN e{i} ON t.{c} = e{i}.v")
        sel.append(f"e{i}.code AS {c}")
    return tape_sql(", " + ",\n".join(ctes) + f"\nSELECT t.loan_id, {', '.join(sel)} FROM loan_tape t " + " ".join(joins))


@query("label_encode", _label_encode_sql())
def q_label_encode(spark, d):
    return clean.label_encode(labelled_tape(spark, d), _ENC_COLS).select("loan_id", *_ENC_COLS)


DTI_EDGES = [0.0, 0.02, 0.04, 0.06, 0.08]


def _cut_sql(c: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {c} > {a}::DOUBLE AND {c} <= {b}::DOUBLE THEN {lab}"
                     for a, b, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {whens} END"


@query("cut_bins", tape_sql(
    "SELECT loan_id, "
    + _cut_sql("dti", DTI_EDGES, [f"'({a:g},{b:g}]'" for a, b in zip(DTI_EDGES[:-1], DTI_EDGES[1:])]) + " AS dti_bucket, "
    + _cut_sql("dti", DTI_EDGES, [f"{b}::DOUBLE" for b in DTI_EDGES[1:]]) + " AS dti_bucket_value FROM loan_tape"))
def q_cut_bins(spark, d):
    t = clean.cut_bins(labelled_tape(spark, d), "dti", DTI_EDGES, value_out="dti_bucket_value")
    return t.select("loan_id", "dti_bucket", "dti_bucket_value")


@query("equal_width_bins", tape_sql(f""", s AS (SELECT CAST(min(fico) AS DOUBLE) AS lo, CAST(max(fico) AS DOUBLE) AS hi FROM loan_tape),
st AS (SELECT lo, hi, CASE WHEN round_even((hi - lo) / 12.0, 0) > 0 THEN round_even((hi - lo) / 12.0, 0)
                          ELSE (hi - lo) / 12.0 END AS step FROM s),
st2 AS (SELECT *, floor((hi - lo) / step) + 1 AS m FROM st),
st3 AS (SELECT *, CASE WHEN lo + (m - 1) * step < hi THEN m ELSE m - 1 END AS bins FROM st2),
b AS (SELECT CAST(least(ceil((CAST(fico AS DOUBLE) - lo) / step), bins) AS INTEGER) AS bin, default_flag, lo, hi, step, bins
      FROM loan_tape, st3 WHERE CAST(fico AS DOUBLE) > lo)
SELECT bin, {r6('lo + (bin - 1) * step')} AS bin_lower,
       {r6('CASE WHEN bin = bins THEN hi ELSE lo + bin * step END')} AS bin_upper,
       {r6('avg(default_flag)')} AS mean_default, count(*) AS n
FROM b GROUP BY bin, lo, hi, step, bins"""))
def q_equal_width_bins(spark, d):
    return clean.equal_width_bins(labelled_tape(spark, d), "fico", 12)


# fixed values: purpose recode used by the map_values query
PURPOSE_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}


@query("map_values", tape_sql(
    "SELECT loan_id, purpose, CASE purpose "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PURPOSE_CODES.items())
    + " END AS purpose_code FROM loan_tape"))
def q_map_values(spark, d):
    return clean.map_values(labelled_tape(spark, d), "purpose", PURPOSE_CODES).select("loan_id", "purpose", "purpose_code")


@query("region_lookup", tape_sql(
    """, m AS (SELECT n.n_name AS state, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT t.loan_id, t.state, m.region FROM loan_tape t LEFT JOIN m ON t.state = m.state"""))
def q_region_lookup(spark, d):
    nation = read_table(spark, d, "nation")
    region = read_table(spark, d, "region")
    mapping = nation.join(region, nation.n_regionkey == region.r_regionkey) \
                    .select(F.col("n_name").alias("state"), F.col("r_name").alias("region"))
    return clean.left_lookup_join(labelled_tape(spark, d), mapping, "state").select("loan_id", "state", "region")


@query("lump_rare", tape_sql(
    """, c AS (SELECT state, count(*) AS n FROM loan_tape WHERE state IS NOT NULL GROUP BY state),
tot AS (SELECT count(*) AS total FROM loan_tape)
SELECT t.loan_id, t.state,
       CASE WHEN t.state IS NULL THEN NULL WHEN c.n > 0.04::DOUBLE * tot.total THEN t.state ELSE 'Other' END AS state_lumped
FROM loan_tape t LEFT JOIN c ON t.state = c.state CROSS JOIN tot"""))
def q_lump_rare(spark, d):
    return clean.lump_rare(labelled_tape(spark, d), "state", 0.04, out="state_lumped").select("loan_id", "state", "state_lumped")


@query("format_percent", tape_sql(
    "SELECT grade AS value, printf('%.2f%%', avg(default_flag) * 100.0) AS default_rate_pct "
    "FROM loan_tape WHERE grade IS NOT NULL GROUP BY grade"))
def q_format_percent(spark, d):
    rates = default_rate_by(labelled_tape(spark, d), "grade")
    return clean.format_percent(rates, "mean_default", out="default_rate_pct").select("value", "default_rate_pct")



@query("round_to", tape_sql("SELECT loan_id, round(CAST(fico AS DOUBLE) / 7, 2) AS fico_7 FROM loan_tape"))
def q_round_to(spark, d):
    return clean.round_to(labelled_tape(spark, d).select("loan_id", (F.col("fico").cast("double") / 7).alias("fico_7")), ["fico_7"], 2)


# ---------------------------------------------------------------- sources and schema operations

@query("read_tape", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def q_read_tape(spark, d):
    """A tape read with a declared schema: only the declared columns are scanned."""
    from tapewise.sources.tape import read_tape

    return read_tape(spark, f"{d}/orders.parquet", schema="o_orderkey bigint, o_totalprice double, o_orderstatus string")


@query("read_mapping", "SELECT n_nationkey AS state_key, n_name AS state, n_regionkey AS region_key FROM nation")
def q_read_mapping(spark, d):
    from tapewise.sources.tape import read_mapping

    return read_mapping(spark, f"{d}/nation.parquet", names=["state_key", "state", "region_key"], fmt="parquet")


@query("inline_mapping", tape_sql(
    "SELECT loan_id, purpose, CAST(CASE purpose "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PURPOSE_CODES.items())
    + " END AS BIGINT) AS purpose_code FROM loan_tape"))
def q_inline_mapping(spark, d):
    """Literal code table (size known on the driver, so broadcast is safe) left-joined onto the tape."""
    from tapewise.sources.tape import inline_mapping

    m = inline_mapping(spark, PURPOSE_CODES, "purpose", "purpose_code")
    return clean.left_lookup_join(labelled_tape(spark, d), m, "purpose", broadcast=True) \
        .select("loan_id", "purpose", "purpose_code")


@query("rename_all", "SELECT r_regionkey AS region_key, r_name AS region_name FROM region")
def q_rename_all(spark, d):
    from tapewise.sources.tape import rename_all

    return rename_all(read_table(spark, d, "region"), ["region_key", "region_name"])


@query("rename", tape_sql("SELECT loan_id, apr AS interest_apr FROM loan_tape"))
def q_rename(spark, d):
    from tapewise.sources.tape import rename

    return rename(labelled_tape(spark, d), {"apr": "interest_apr"}).select("loan_id", "interest_apr")


@query("drop_columns", tape_sql("SELECT * EXCLUDE (origination_date, charged_off_date, status) FROM loan_tape"))
def q_drop_columns(spark, d):
    from tapewise.sources.tape import drop_columns

    return drop_columns(labelled_tape(spark, d), ["origination_date", "charged_off_date", "status"])


@query("inspect_schema")
def q_inspect_schema(spark, d):
    from tapewise.sources.tape import inspect_schema

    return inspect_schema(labelled_tape(spark, d))


@query("project", tape_sql("SELECT loan_id, grade, apr FROM loan_tape"))
def q_project(spark, d):
    return clean.project(labelled_tape(spark, d), ["loan_id", "grade", "apr"])


@query("filter_range", tape_sql("SELECT loan_id, fico FROM loan_tape WHERE fico >= 600 AND fico <= 700"))
def q_filter_range(spark, d):
    return clean.filter_range(labelled_tape(spark, d), "fico", 600, 700).select("loan_id", "fico")


@query("filter_eq", tape_sql("SELECT loan_id, status FROM loan_tape WHERE default_flag = 1"))
def q_filter_eq(spark, d):
    return clean.filter_eq(labelled_tape(spark, d), "default_flag", 1).select("loan_id", "status")


@query("as_number", tape_sql("SELECT loan_id, TRY_CAST(grade AS DOUBLE) AS grade, TRY_CAST(purpose AS DOUBLE) AS purpose FROM loan_tape"))
def q_as_number(spark, d):
    return clean.as_number(labelled_tape(spark, d), ["grade", "purpose"]).select("loan_id", "grade", "purpose")


@query("as_string", tape_sql("SELECT loan_id, CAST(term_months AS VARCHAR) AS term_months FROM loan_tape"))
def q_as_string(spark, d):
    return clean.as_string(labelled_tape(spark, d), ["term_months"]).select("loan_id", "term_months")


@query("blank_to_null", tape_sql(f"SELECT loan_id, NULLIF({_BLANKED}, '') AS home_ownership FROM loan_tape"))
def q_blank_to_null(spark, d):
    from tapewise.sources.tape import blank_to_null

    t = labelled_tape(spark, d)
    t = t.withColumn("home_ownership", F.when(F.col("home_ownership").isNull() & (F.col("loan_id") % 2 == 0), F.lit(""))
                     .otherwise(F.col("home_ownership")))
    return blank_to_null(t, ["home_ownership"]).select("loan_id", "home_ownership")


@query("head_limit", tape_sql("SELECT loan_id, loan_amount FROM loan_tape ORDER BY loan_amount DESC, loan_id LIMIT 20"))
def q_head_limit(spark, d):
    """Top-20 loans by amount: the limit is the report (a top-k)."""
    return labelled_tape(spark, d).select("loan_id", "loan_amount") \
        .orderBy(F.desc("loan_amount"), "loan_id").limit(20)


# fixed values: inquiry bucket edges of the model frame
INQ_EDGES = [0, 0.5, 1.0, 2, 105]


@query("bucket_fill_999", tape_sql(
    "SELECT loan_id, coalesce("
    + _cut_sql("CAST(inquiries_6m AS DOUBLE)", INQ_EDGES,
               [f"'({a:g},{b:g}]'" for a, b in zip(INQ_EDGES[:-1], INQ_EDGES[1:])])
    + ", '999') AS inq6_bucket, coalesce(CAST(fico AS VARCHAR), '999') AS fico FROM loan_tape"))
def q_bucket_fill_999(spark, d):
    """Model-frame preparation: right-closed inquiry buckets (0 and NULL fall outside), then '999' for missing."""
    t = clean.cut_bins(labelled_tape(spark, d), "inquiries_6m", INQ_EDGES, out="inq6_bucket")
    return clean.fill_const(t, {"inq6_bucket": "999", "fico": "999"}).select("loan_id", "inq6_bucket", "fico")


@query("filter_amount_range", tape_sql(
    "SELECT loan_id, loan_amount FROM loan_tape WHERE loan_amount >= 100000 AND loan_amount <= 200000"))
def q_filter_amount_range(spark, d):
    """A range on a source column: Catalyst pushes it through the projection into the orders scan."""
    return clean.filter_range(labelled_tape(spark, d), "loan_amount", 100000.0, 200000.0).select("loan_id", "loan_amount")
