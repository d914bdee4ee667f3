"""Registered queries: profiling and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewise.operators import profile as P
from tapewise.operators.returns import cutoff_sweep
from tapewise.plans.registry import query, r6, tape_sql, union_long
from tapewise.sources.fixture import labelled_tape

VC_COLS = ["grade", "purpose", "home_ownership", "term_months"]


@query("value_counts", tape_sql(", u AS (" + union_long(VC_COLS, "'{c}' AS field, CAST({c} AS VARCHAR) AS value")
                                + ") SELECT field, value, count(*) AS n FROM u GROUP BY field, value"))
def q_value_counts(spark, d):
    return P.value_counts(labelled_tape(spark, d), VC_COLS)


@query("row_count", tape_sql("SELECT count(*) AS n FROM loan_tape"))
def q_row_count(spark, d):
    return P.row_count(labelled_tape(spark, d))


DESC_COLS = ["loan_amount", "apr", "fico", "dti", "annual_income", "inquiries_6m"]

_SUMMARY = (f"count(value) AS count, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std, "
            f"{r6('min(value)')} AS min, {r6('quantile_cont(value, 0.25)')} AS p25, "
            f"{r6('quantile_cont(value, 0.5)')} AS p50, {r6('quantile_cont(value, 0.75)')} AS p75, "
            f"{r6('max(value)')} AS max")


@query("describe", tape_sql(", u AS (" + union_long(DESC_COLS, "'{c}' AS field, CAST({c} AS DOUBLE) AS value")
                            + f") SELECT field, {_SUMMARY} FROM u GROUP BY field"))
def q_describe(spark, d):
    return P.describe(labelled_tape(spark, d), DESC_COLS)


DESC_BY_COLS = ["inquiries_6m", "fico"]


@query("describe_by", tape_sql(
    ", u AS (" + union_long(DESC_BY_COLS, "'{c}' AS field, default_flag, CAST({c} AS DOUBLE) AS value")
    + f") SELECT field, default_flag, {_SUMMARY} FROM u GROUP BY field, default_flag"))
def q_describe_by(spark, d):
    return P.describe_by(labelled_tape(spark, d), DESC_BY_COLS, "default_flag")


ND_COLS = ["grade", "purpose", "state", "home_ownership", "fico", "apr"]


@query("n_distinct", tape_sql(
    ", u AS (" + union_long(ND_COLS, "'{c}' AS field, CAST({c} AS VARCHAR) AS value") + ")"
    " SELECT field, count(DISTINCT value) AS n_distinct,"
    " count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS n_distinct_with_null"
    " FROM u GROUP BY field"))
def q_n_distinct(spark, d):
    return P.n_distinct(labelled_tape(spark, d), ND_COLS)


@query("unique_values", tape_sql("SELECT DISTINCT purpose FROM loan_tape"))
def q_unique_values(spark, d):
    return P.unique_values(labelled_tape(spark, d), "purpose")


@query("crosstab_margins", tape_sql(
    """, b AS (SELECT grade, CAST(default_flag AS VARCHAR) AS default_flag FROM loan_tape
           WHERE grade IS NOT NULL AND default_flag IS NOT NULL)
SELECT CASE WHEN grouping(grade) = 1 THEN 'All' ELSE grade END AS grade,
       CASE WHEN grouping(default_flag) = 1 THEN 'All' ELSE default_flag END AS default_flag,
       count(*) AS n
FROM b GROUP BY CUBE (grade, default_flag)"""))
def q_crosstab_margins(spark, d):
    return P.crosstab(labelled_tape(spark, d), "grade", "default_flag", margins=True)


@query("crosstab_wide", tape_sql(
    """, b AS (SELECT grade, default_flag FROM loan_tape WHERE grade IS NOT NULL AND default_flag IS NOT NULL)
SELECT CASE WHEN grouping(grade) = 1 THEN 'All' ELSE grade END AS grade, count(*) FILTER (WHERE default_flag = 0) AS "0",
       count(*) FILTER (WHERE default_flag = 1) AS "1", count(*) AS "All" FROM b GROUP BY ROLLUP (grade)"""))
def q_crosstab_wide(spark, d):
    return P.crosstab(labelled_tape(spark, d), "grade", "default_flag", margins=True, wide=True)


RATE_COLS = ["grade", "purpose", "state", "home_ownership", "term_months", "modified_flag"]


@query("default_rates_by_field", tape_sql(
    ", u AS (" + union_long(RATE_COLS, "'{c}' AS field, CAST({c} AS VARCHAR) AS value, default_flag") + ")\n"
    f"SELECT field, value, {r6('avg(default_flag)')} AS mean_default, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY field, value"))
def q_default_rates_by_field(spark, d):
    return P.default_rates_by_field(labelled_tape(spark, d), RATE_COLS)


@query("default_rate_by", tape_sql(
    f"SELECT state AS value, {r6('avg(default_flag)')} AS mean_default, count(*) AS n "
    "FROM loan_tape WHERE state IS NOT NULL GROUP BY state"))
def q_default_rate_by(spark, d):
    return P.default_rate_by(labelled_tape(spark, d), "state")


GRADE_ORDER = ["1", "2", "3", "4", "5", "9"]  # '9' is absent from the data


@query("mean_by_ordered", tape_sql(
    ", lv AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{g}')" for i, g in enumerate(GRADE_ORDER))
    + ") v(ord, grade)), m AS (SELECT grade, avg(fico) AS mean_fico FROM loan_tape GROUP BY grade)"
    f" SELECT lv.grade, CAST(lv.ord AS INTEGER) AS ord, {r6('m.mean_fico')} AS mean_fico FROM lv LEFT JOIN m ON lv.grade = m.grade"))
def q_mean_by_ordered(spark, d):
    return P.mean_by_ordered(labelled_tape(spark, d), "fico", "grade", GRADE_ORDER)


HIST_COLS = ["loan_amount", "annual_income", "revolving_balance"]


def _hist_sql(cols, by: str | None, bins: int = 10) -> str:
    keep = f"{by}, " if by else ""
    u = union_long(cols, "'{c}' AS field, " + keep + "CAST({c} AS DOUBLE) AS value")
    levels = f", lv AS (SELECT DISTINCT {by} FROM u2)" if by else ""
    grid_from = "s CROSS JOIN range(" + str(bins) + ") r(bin)" + (" CROSS JOIN lv" if by else "")
    keys = ["field"] + ([by] if by else []) + ["bin"]
    on = " AND ".join(f"g.{k} = c.{k}" for k in keys)
    w = f"((hi - lo) / {float(bins)})"
    return tape_sql(f""", u AS ({u}),
u2 AS (SELECT * FROM u WHERE value IS NOT NULL),
s AS (SELECT field, min(value) AS lo, max(value) AS hi FROM u2 GROUP BY field){levels},
b AS (SELECT u2.*, CAST(least(coalesce(floor((value - lo) / {w}), 0), {bins - 1}) AS INTEGER) AS bin
      FROM u2 JOIN s USING (field)),
c AS (SELECT field, {keep}bin, count(*) AS n FROM b GROUP BY ALL),
g AS (SELECT * FROM {grid_from})
SELECT g.field, {('g.' + by + ', ') if by else ''}CAST(g.bin AS INTEGER) AS bin,
       {r6(f'lo + g.bin * {w}')} AS bin_lower, {r6(f'lo + (g.bin + 1) * {w}')} AS bin_upper,
       coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON {on}""")


@query("histogram", _hist_sql(HIST_COLS, None))
def q_histogram(spark, d):
    return P.histogram(labelled_tape(spark, d), HIST_COLS, bins=10)


HIST_BY_COLS = ["loan_amount", "annual_income"]


@query("histogram_by", _hist_sql(HIST_BY_COLS, "default_flag"))
def q_histogram_by(spark, d):
    return P.histogram_by(labelled_tape(spark, d), HIST_BY_COLS, "default_flag", bins=10)


@query("stacked_amount", tape_sql(
    "SELECT grade, default_flag, round(sum(loan_amount), 2) AS total_amount FROM loan_tape GROUP BY grade, default_flag"))
def q_stacked_amount(spark, d):
    out = P.stacked_amount(labelled_tape(spark, d), "grade", "default_flag", "loan_amount")
    return out.withColumn("total_amount", F.round("total_amount", 2))


@query("stacked_count", tape_sql("SELECT grade, default_flag, count(*) AS n FROM loan_tape GROUP BY grade, default_flag"))
def q_stacked_count(spark, d):
    return P.stacked_count(labelled_tape(spark, d), "grade", "default_flag")


SHARE_COLS = ["grade", "purpose", "home_ownership"]


@query("share_by", tape_sql(
    ", u AS (" + union_long(SHARE_COLS, "'{c}' AS field, CAST({c} AS VARCHAR) AS value")
    + "), c AS (SELECT field, value, count(*) AS n FROM u GROUP BY field, value)"
    f" SELECT field, value, n, {r6('n / sum(n) OVER (PARTITION BY field)')} AS share FROM c"))
def q_share_by(spark, d):
    return P.share_by(labelled_tape(spark, d), SHARE_COLS)


BOX_COLS = ["apr", "dti", "fico"]


@query("box_stats", tape_sql(
    ", u AS (" + union_long(BOX_COLS, "'{c}' AS field, default_flag, CAST({c} AS DOUBLE) AS value")
    + """), u2 AS (SELECT * FROM u WHERE value IS NOT NULL),
q AS (SELECT field, default_flag, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM u2 GROUP BY field, default_flag)
SELECT q.field, q.default_flag, """ + ", ".join([
        f"{r6('q1')} AS q1", f"{r6('median')} AS median", f"{r6('q3')} AS q3",
        r6("min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END)") + " AS whisker_lo",
        r6("max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END)") + " AS whisker_hi",
        "count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers",
        "count(*) AS n"])
    + " FROM u2 JOIN q ON u2.field = q.field AND u2.default_flag = q.default_flag"
      " GROUP BY q.field, q.default_flag, q1, median, q3"))
def q_box_stats(spark, d):
    return P.box_stats(labelled_tape(spark, d), BOX_COLS, "default_flag")


@query("scatter_sample", tape_sql(
    """SELECT loan_id, apr, revolving_util, home_ownership FROM loan_tape
WHERE home_ownership IS NULL OR home_ownership <> ''
ORDER BY ('0x' || substr(md5('3:' || CAST(loan_id AS VARCHAR)), 1, 8))::BIGINT, loan_id LIMIT 500"""))
def q_scatter_sample(spark, d):
    return P.scatter_sample(labelled_tape(spark, d), "apr", "revolving_util", "home_ownership", 500, "loan_id", seed=3)


SWEEP_SQL = """, cuts AS (SELECT CAST(range AS DOUBLE) AS cutoff FROM range(500, 850, 10)),
sweep AS (
  SELECT c.cutoff, count(t.loan_id) AS n,
         sum(t.default_flag) / count(t.loan_id) AS default_rate,
         avg(t.apr) AS avg_apr
  FROM cuts c LEFT JOIN loan_tape t ON CAST(t.fico AS DOUBLE) >= c.cutoff
  GROUP BY c.cutoff),
sweep2 AS (SELECT cutoff, n, default_rate, avg_apr, avg_apr - 100.0 * default_rate AS def_adj_return FROM sweep)
"""


@query("trend_line", tape_sql(SWEEP_SQL + f"""SELECT {r6('regr_slope(def_adj_return, cutoff)')} AS slope,
  {r6('regr_intercept(def_adj_return, cutoff)')} AS intercept, {r6('regr_r2(def_adj_return, cutoff)')} AS r2,
  CAST(regr_count(def_adj_return, cutoff) AS BIGINT) AS n FROM sweep2"""))
def q_trend_line(spark, d):
    sweep = cutoff_sweep(labelled_tape(spark, d), "fico", 500, 850, 10)
    return P.trend_line(sweep, "cutoff", "def_adj_return")
