"""Registered queries: default-adjusted returns and portfolios."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewise.operators import portfolio as PF
from tapewise.operators import returns as R
from tapewise.plans.q_profile import SWEEP_SQL
from tapewise.plans.registry import query, r6, tape_sql, union_long
from tapewise.sources.fixture import labelled_tape

DAR_FEATURES = ["apr", "inquiries_6m", "annual_income", "dti", "fico"]
DAR_UP = ["annual_income", "fico"]


def _dar_sql(p: float = 0.75) -> str:
    cuts = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), {p if c in DAR_UP else 1.0 - p}) AS c{i}" for i, c in enumerate(DAR_FEATURES))
    parts = []
    for i, c in enumerate(DAR_FEATURES):
        op = ">=" if c in DAR_UP else "<="
        m = f"CAST({c} AS DOUBLE) {op} c{i}"
        rate = f"sum(default_flag) FILTER (WHERE {m}) / count(*) FILTER (WHERE {m})"
        aprx = f"avg(apr) FILTER (WHERE {m})"
        parts.append(
            f"SELECT '{c}' AS field, '{'positive' if c in DAR_UP else 'negative'}' AS direction, {r6(f'c{i}')} AS cutoff, "
            f"count(*) FILTER (WHERE {m}) AS n, {r6(rate)} AS default_rate, {r6(aprx)} AS avg_apr, "
            f"{r6(f'{aprx} - 100.0 * ({rate})')} AS def_adj_return FROM loan_tape, cuts GROUP BY c{i}")
    parts.append(f"SELECT 'All', 'NA', 0.0::DOUBLE, count(*), {r6('avg(default_flag)')}, {r6('avg(apr)')}, "
                 f"{r6('avg(apr) - 100.0 * avg(default_flag)')} FROM loan_tape")
    return tape_sql(f", cuts AS (SELECT {cuts} FROM loan_tape)\n" + "\nUNION ALL\n".join(parts))


@query("def_adj_rets", _dar_sql(0.75))
def q_def_adj_rets(spark, d):
    return R.def_adj_rets(labelled_tape(spark, d), DAR_FEATURES, DAR_UP, 0.75)


@query("def_adj_rets_50", _dar_sql(0.5))
def q_def_adj_rets_50(spark, d):
    return R.def_adj_rets(labelled_tape(spark, d), DAR_FEATURES, DAR_UP, 50)


RBC_COLS = ["grade", "purpose", "state", "home_ownership", "term_months"]


def _rbc_cte(cols, name: str = "rbc") -> str:
    u = union_long(cols, "'{c}' AS field, CAST({c} AS VARCHAR) AS value, default_flag, apr")
    return (f", {name}_u AS ({u}),\n{name} AS (SELECT field, value, avg(default_flag) AS default_rate, avg(apr) AS avg_apr, "
            f"count(*) AS freq, avg(apr) - 100.0 * avg(default_flag) AS def_adj_return FROM {name}_u "
            f"WHERE value IS NOT NULL GROUP BY field, value)\n")


@query("return_by_category", tape_sql(
    _rbc_cte(RBC_COLS) + f"SELECT field, value, {r6('default_rate')} AS default_rate, {r6('avg_apr')} AS avg_apr, freq, "
    f"{r6('def_adj_return')} AS def_adj_return FROM rbc"))
def q_return_by_category(spark, d):
    return R.return_by_category(labelled_tape(spark, d), RBC_COLS)


@query("cutoff_sweep", tape_sql(
    SWEEP_SQL + f"SELECT cutoff, n, {r6('default_rate')} AS default_rate, {r6('avg_apr')} AS avg_apr, "
    f"{r6('def_adj_return')} AS def_adj_return FROM sweep2"))
def q_cutoff_sweep(spark, d):
    return R.cutoff_sweep(labelled_tape(spark, d), "fico", 500, 850, 10)


@query("argmax_row", tape_sql(
    SWEEP_SQL + f"SELECT cutoff, n, {r6('default_rate')} AS default_rate, {r6('avg_apr')} AS avg_apr, "
    f"{r6('def_adj_return')} AS def_adj_return FROM sweep2 WHERE def_adj_return IS NOT NULL "
    "ORDER BY def_adj_return DESC, cutoff ASC LIMIT 1"))
def q_argmax_row(spark, d):
    sweep = R.cutoff_sweep(labelled_tape(spark, d), "fico", 500, 850, 10)
    return R.argmax_row(sweep, "cutoff", "def_adj_return")


ALPHA_COLS = ["grade", "purpose", "state", "home_ownership", "modified_flag"]


def _alpha_ctes(cols, share: float = 0.2) -> str:
    return _rbc_cte(cols) + f""", quota AS (SELECT floor(count(*) * {share}::DOUBLE) AS quota FROM loan_tape),
ranked AS (SELECT *, coalesce(sum(freq) OVER (PARTITION BY field ORDER BY round(def_adj_return, 9) DESC, value ASC
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS freq_before FROM rbc),
sel AS (SELECT field, value, def_adj_return, freq, CAST(freq_before AS BIGINT) AS freq_before
        FROM ranked, quota WHERE freq_before <= quota)
"""


@query("select_alpha_values", tape_sql(
    _alpha_ctes(ALPHA_COLS) + f"SELECT field, value, {r6('def_adj_return')} AS def_adj_return, freq, freq_before FROM sel"))
def q_select_alpha_values(spark, d):
    return R.select_alpha_values(labelled_tape(spark, d), ALPHA_COLS, share=0.2)


FLAGSHIP_COLS = ["grade", "purpose", "home_ownership"]

_METRICS_SELECT = (
    "SELECT (SELECT count(*) FROM loan_tape) AS n_total, count(*) AS n_subset, "
    f"{r6('avg(default_flag)')} AS default_rate, {r6('avg(apr)')} AS avg_apr, "
    f"{r6('avg(apr) - 100.0 * avg(default_flag)')} AS def_adj_return, "
    f"{r6('100.0::DOUBLE * count(*) / (SELECT count(*) FROM loan_tape)')} AS pct_picked FROM sub")


@query("alpha_portfolio", tape_sql(
    _alpha_ctes(FLAGSHIP_COLS)
    + ", sub AS (SELECT * FROM loan_tape WHERE "
    + " AND ".join(f"CAST({c} AS VARCHAR) IN (SELECT value FROM sel WHERE field = '{c}')" for c in FLAGSHIP_COLS)
    + ")\n" + _METRICS_SELECT))
def q_alpha_portfolio(spark, d):
    """The minimum slice: category returns -> alpha values -> AND portfolio -> its metrics."""
    tape = labelled_tape(spark, d)
    sel = R.select_alpha_values(tape, FLAGSHIP_COLS, share=0.2)
    picked = PF.portfolio_from_selection(tape, sel, FLAGSHIP_COLS, mode="all")
    return PF.portfolio_metrics(tape, picked)


# fixed values: the hand edit of the selection, a field left out and the grades set
EDIT_DROP, EDIT_GRADES = ["home_ownership"], ["2", "3", "5"]
_EDITED = ("purpose IN (SELECT value FROM sel WHERE field = 'purpose') {op} grade IN ('2', '3', '5')")


def _edited(spark, d, mode):
    """Selection -> hand edit -> portfolio -> its metrics."""
    tape = labelled_tape(spark, d)
    criteria = PF.selected_criteria(R.select_alpha_values(tape, FLAGSHIP_COLS, share=0.2))
    criteria = PF.edit_criteria(criteria, drop=EDIT_DROP, override={"grade": EDIT_GRADES})
    combine = PF.any_of if mode == "any" else PF.all_of
    return PF.portfolio_metrics(tape, combine(PF.criteria_predicates(criteria)))


@query("edited_portfolio_all", tape_sql(
    _alpha_ctes(FLAGSHIP_COLS) + ", sub AS (SELECT * FROM loan_tape WHERE " + _EDITED.format(op="AND") + ")\n" + _METRICS_SELECT))
def q_edited_portfolio_all(spark, d):
    return _edited(spark, d, "all")


@query("edited_portfolio_any", tape_sql(
    _alpha_ctes(FLAGSHIP_COLS) + ", sub AS (SELECT * FROM loan_tape WHERE " + _EDITED.format(op="OR") + ")\n" + _METRICS_SELECT))
def q_edited_portfolio_any(spark, d):
    return _edited(spark, d, "any")


@query("alpha_portfolio_any", tape_sql(
    _alpha_ctes(FLAGSHIP_COLS) + ", sub AS (SELECT * FROM loan_tape WHERE "
    + " OR ".join(f"CAST({c} AS VARCHAR) IN (SELECT value FROM sel WHERE field = '{c}')" for c in FLAGSHIP_COLS) + ")\n" + _METRICS_SELECT))
def q_alpha_portfolio_any(spark, d):
    """The OR portfolio of the selection."""
    tape = labelled_tape(spark, d)
    sel = R.select_alpha_values(tape, FLAGSHIP_COLS, share=0.2)
    return PF.portfolio_metrics(tape, PF.portfolio_from_selection(tape, sel, FLAGSHIP_COLS, mode="any"))


@query("portfolio_any", tape_sql(
    "SELECT loan_id, inquiries_6m, fico FROM loan_tape WHERE coalesce(inquiries_6m <= 0 OR fico >= 707, false)"))
def q_portfolio_any(spark, d):
    t = labelled_tape(spark, d)
    return PF.portfolio_any(t, [F.col("inquiries_6m") <= 0, F.col("fico") >= 707]).select("loan_id", "inquiries_6m", "fico")


# fixed values: the AND-portfolio criteria of the portfolio queries
CRITERIA = {"grade": ["2", "3", "5"], "purpose": ["BUILDING", "HOUSEHOLD", "MACHINERY"]}
ALL_SQL = ("grade IN ('2', '3', '5') AND purpose IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') "
           "AND modified_flag = false AND inquiries_6m <= 0")


def _all_predicates():
    return PF.criteria_predicates(CRITERIA) + [F.col("modified_flag") == F.lit(False), F.col("inquiries_6m") <= 0]


@query("portfolio_all", tape_sql(f"SELECT loan_id, grade, purpose FROM loan_tape WHERE coalesce({ALL_SQL}, false)"))
def q_portfolio_all(spark, d):
    return PF.portfolio_all(labelled_tape(spark, d), _all_predicates()).select("loan_id", "grade", "purpose")


@query("portfolio_metrics", tape_sql(
    f"SELECT count(*) AS n_total, count(*) FILTER (WHERE coalesce({ALL_SQL}, false)) AS n_subset, "
    + r6(f"sum(default_flag) FILTER (WHERE coalesce({ALL_SQL}, false)) / count(*) FILTER (WHERE coalesce({ALL_SQL}, false))")
    + " AS default_rate, " + r6(f"avg(apr) FILTER (WHERE coalesce({ALL_SQL}, false))") + " AS avg_apr, "
    + r6(f"avg(apr) FILTER (WHERE coalesce({ALL_SQL}, false)) - 100.0 * sum(default_flag) FILTER (WHERE coalesce({ALL_SQL}, false)) "
         f"/ count(*) FILTER (WHERE coalesce({ALL_SQL}, false))") + " AS def_adj_return, "
    + r6(f"100.0::DOUBLE * count(*) FILTER (WHERE coalesce({ALL_SQL}, false)) / count(*)") + " AS pct_picked FROM loan_tape"))
def q_portfolio_metrics(spark, d):
    return PF.portfolio_metrics(labelled_tape(spark, d), PF.all_of(_all_predicates()))


@query("union_dedup", tape_sql(
    """SELECT DISTINCT loan_id, grade, purpose, state FROM (
  SELECT loan_id, grade, purpose, state FROM loan_tape WHERE grade IN ('1', '2')
  UNION ALL SELECT loan_id, grade, purpose, state FROM loan_tape WHERE purpose = 'BUILDING'
  UNION ALL SELECT loan_id, grade, purpose, state FROM loan_tape WHERE state IN ('ALGERIA', 'BRAZIL'))"""))
def q_union_dedup(spark, d):
    t = labelled_tape(spark, d).select("loan_id", "grade", "purpose", "state")
    parts = [t.filter(F.col("grade").isin("1", "2")), t.filter(F.col("purpose") == "BUILDING"),
             t.filter(F.col("state").isin("ALGERIA", "BRAZIL"))]
    return PF.union_dedup(parts)


@query("membership_flag", tape_sql(
    f", sub AS (SELECT loan_id FROM loan_tape WHERE coalesce({ALL_SQL}, false))\n"
    "SELECT t.loan_id, CASE WHEN s.loan_id IS NULL THEN 0 ELSE 1 END AS in_subset "
    "FROM loan_tape t LEFT JOIN sub s ON t.loan_id = s.loan_id"))
def q_membership_flag(spark, d):
    t = labelled_tape(spark, d)
    subset = PF.portfolio_all(t, _all_predicates())
    return PF.membership_flag(t, subset, "loan_id").select("loan_id", "in_subset")


@query("criteria_dummies", tape_sql(
    """SELECT loan_id,
  coalesce(CAST(grade IN ('2', '3', '5') AS INTEGER), 0) AS dummy_grade,
  coalesce(CAST(purpose IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') AS INTEGER), 0) AS dummy_purpose,
  coalesce(CAST(modified_flag = false AS INTEGER), 0) AS dummy_modflag,
  coalesce(CAST(inquiries_6m <= 0 AS INTEGER), 0) AS dummy_inq6mo,
  least(coalesce(CAST(grade IN ('2', '3', '5') AS INTEGER), 0),
        coalesce(CAST(purpose IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') AS INTEGER), 0),
        coalesce(CAST(modified_flag = false AS INTEGER), 0),
        coalesce(CAST(inquiries_6m <= 0 AS INTEGER), 0)) AS dmy_all
FROM loan_tape"""))
def q_criteria_dummies(spark, d):
    g, p, m, i = _all_predicates()
    crit = {"dummy_grade": g, "dummy_purpose": p, "dummy_modflag": m, "dummy_inq6mo": i}
    return PF.criteria_dummies(labelled_tape(spark, d), crit, "dmy_all").select("loan_id", *crit, "dmy_all")
