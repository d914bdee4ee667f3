"""Registered queries: association with default."""

from __future__ import annotations

from tapewise.operators import assoc as A
from tapewise.plans.registry import query, r6, tape_sql, union_long
from tapewise.sources.fixture import labelled_tape

CAT_COLS = ["grade", "purpose", "home_ownership", "term_months"]


def _chi_sql(yates: bool) -> str:
    u = union_long(CAT_COLS, "'{c}' AS field, CAST({c} AS VARCHAR) AS value, default_flag")
    diff = "abs(o - r * c / n)"
    if yates:
        term = f"power({diff} - CASE WHEN k = 2 AND m = 2 THEN least(0.5, {diff}) ELSE 0 END, 2) / (r * c / n)"
    else:
        term = f"power({diff}, 2) / (r * c / n)"
    return f""", u AS ({u}),
cells AS (SELECT field, value, default_flag, count(*) AS o FROM u
          WHERE value IS NOT NULL AND default_flag IS NOT NULL GROUP BY ALL),
rt AS (SELECT field, value, CAST(sum(o) AS DOUBLE) AS r FROM cells GROUP BY ALL),
ct AS (SELECT field, default_flag, CAST(sum(o) AS DOUBLE) AS c FROM cells GROUP BY ALL),
dims AS (SELECT field, CAST(sum(o) AS BIGINT) AS n, count(DISTINCT value) AS k, count(DISTINCT default_flag) AS m
         FROM cells GROUP BY field),
g AS (SELECT rt.field, rt.value, ct.default_flag, rt.r, ct.c, coalesce(cells.o, 0) AS o, dims.n, dims.k, dims.m
      FROM rt JOIN ct ON rt.field = ct.field
      LEFT JOIN cells ON cells.field = rt.field AND cells.value = rt.value AND cells.default_flag = ct.default_flag
      JOIN dims ON dims.field = rt.field),
x AS (SELECT field, k, m, n, sum({term}) AS chi2 FROM g GROUP BY field, k, m, n)
"""


@query("cramers_v_py", tape_sql(_chi_sql(False) + f"""SELECT field, k, m, n, {r6('chi2')} AS chi2,
  k + m - 1 AS dof_ref, (k - 1) * (m - 1) AS dof_std,
  {r6('sqrt(chi2 / n / least(k, m))')} AS v_ref,
  {r6('CASE WHEN least(k, m) > 1 THEN sqrt(chi2 / n / (least(k, m) - 1)) END')} AS v_std
FROM x"""))
def q_cramers_v_py(spark, d):
    return A.cramers_v(labelled_tape(spark, d), CAT_COLS, "default_flag", style="py")


@query("cramers_v_r", tape_sql(_chi_sql(True) + ", lv AS (" + union_long(
    CAT_COLS, "'{c}' AS field, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS k_all, count(*) AS n_rows")
    + "), mm AS (SELECT count(DISTINCT default_flag) AS m_all FROM loan_tape)"
    + f""" SELECT x.field, lv.k_all AS k, lv.n_rows, {r6('chi2')} AS chi2,
  round(sqrt(chi2 / n_rows / least(lv.k_all, mm.m_all)), 3) AS v
FROM x JOIN lv ON x.field = lv.field CROSS JOIN mm"""))
def q_cramers_v_r(spark, d):
    return A.cramers_v(labelled_tape(spark, d), CAT_COLS, "default_flag", style="r")


CONT_COLS = ["loan_amount", "apr", "fico", "dti", "annual_income", "inquiries_6m"]

_PB_U = ", u AS (" + union_long(CONT_COLS, "'{c}' AS field, CAST({c} AS DOUBLE) AS value, default_flag") + \
        "), u2 AS (SELECT * FROM u WHERE value IS NOT NULL AND default_flag IS NOT NULL)"


@query("point_biserial_py", tape_sql(
    _PB_U + f" SELECT field, count(*) AS n, {r6('CASE WHEN isnan(corr(value, default_flag)) THEN NULL ELSE corr(value, default_flag) END')}"
    " AS r FROM u2 GROUP BY field"))
def q_point_biserial_py(spark, d):
    return A.point_biserial(labelled_tape(spark, d), CONT_COLS, "default_flag", style="py")


@query("point_biserial_r", tape_sql(
    _PB_U + " SELECT field, count(*) AS n, "
    + r6("-corr(value, default_flag) * sqrt((count(*) - 1.0) / count(*))") + " AS r_biserial FROM u2 GROUP BY field"))
def q_point_biserial_r(spark, d):
    """The R form is computed from conditional means; the oracle uses the identity -r sqrt((n-1)/n)."""
    return A.point_biserial(labelled_tape(spark, d), CONT_COLS, "default_flag", style="r")


CORR_COLS = ["loan_amount", "apr", "dti", "revolving_util", "annual_income", "fico", "inquiries_6m"]


def _corr_sql() -> str:
    where = " AND ".join(f"{c} IS NOT NULL" for c in CORR_COLS)
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            if a == b:
                expr = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END"
            else:
                expr = f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"
            parts.append(f"SELECT '{a}' AS field_a, '{b}' AS field_b, {expr} AS r FROM cc")
    return tape_sql(f""", cc AS (SELECT * FROM loan_tape WHERE {where}),
pairs AS ({' UNION ALL '.join(parts)})
SELECT field_a, field_b, {r6('r')} AS r, round(r, 1) + 0.0 AS r_rounded FROM pairs""")


@query("corr_matrix", _corr_sql())
def q_corr_matrix(spark, d):
    return A.corr_matrix(labelled_tape(spark, d), CORR_COLS, digits=1)


# both densities are summed on a fine grid, an independent way to the tails
# (in u, the square root of chi-square, where it is smooth)
_CHI2_GRID = """, ds AS (SELECT DISTINCT CAST(k + m - 1 AS DOUBLE) AS d FROM x),
dens AS (SELECT d, i * 2e-5::DOUBLE AS u, 2 * power(i * 2e-5::DOUBLE, d - 1) * exp(-power(i * 2e-5::DOUBLE, 2) / 2 - d / 2 * ln(2) - lgamma(d / 2)) AS f
         FROM ds, range(0, 450001) r(i)),
cum AS (SELECT d, u, f, sum((f + prev) / 2 * 2e-5::DOUBLE) OVER (PARTITION BY d ORDER BY u) AS p
        FROM (SELECT *, coalesce(lag(f) OVER (PARTITION BY d ORDER BY u), -f) AS prev FROM dens)),
crit AS (SELECT d, power(max_by(u + (0.95 - p) / f, u), 2) AS crit FROM cum WHERE p <= 0.95 GROUP BY d),
tail AS (SELECT field, max_by(1 - p - (sqrt(chi2) - u) * f, u) AS p_value FROM x JOIN cum ON cum.d = x.k + x.m - 1 AND u <= sqrt(chi2) GROUP BY field)
"""


@query("chi2_pvalues", tape_sql(_chi_sql(False) + _CHI2_GRID + f"""SELECT x.field, k, m, n, {r6('chi2')} AS chi2,
  k + m - 1 AS dof_ref, (k - 1) * (m - 1) AS dof_std,
  {r6('sqrt(chi2 / n / least(k, m))')} AS v_ref,
  {r6('CASE WHEN least(k, m) > 1 THEN sqrt(chi2 / n / (least(k, m) - 1)) END')} AS v_std, {r6('crit')} AS crit, {r6('p_value')} AS p_value
FROM x JOIN crit ON crit.d = x.k + x.m - 1 JOIN tail USING (field)"""))
def q_chi2_pvalues(spark, d):
    """Critical value at 95 % and upper-tail p-value of each field's chi-square (reference df = k + m - 1)."""
    return A.add_chi2_pvalues(A.cramers_v(labelled_tape(spark, d), CAT_COLS, "default_flag", style="py"),
                              "chi2", "dof_ref")


@query("point_biserial_pvalues", tape_sql(
    _PB_U + ", pb AS (SELECT field, count(*) AS n, corr(value, default_flag) AS r FROM u2 GROUP BY field),\n"
    "tt AS (SELECT *, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS v FROM pb),\n"
    "dens AS (SELECT field, t / 20000 AS h, exp(lgamma((v + 1) / 2) - lgamma(v / 2) - ln(v * pi()) / 2"
    " - (v + 1) / 2 * ln(1 + (i * t / 20000) ** 2 / v)) * CASE WHEN i IN (0, 20000) THEN 0.5 ELSE 1 END AS f FROM tt, range(0, 20001) g(i))\n"
    f"SELECT field, n, {r6('r')} AS r, {r6('1 - 2 * (SELECT sum(f * h) FROM dens WHERE dens.field = tt.field)')} AS p_value FROM tt"))
def q_point_biserial_pvalues(spark, d):
    """Two-sided p-value of each point-biserial r (t distribution, n - 2 df)."""
    return A.add_t_pvalues(A.point_biserial(labelled_tape(spark, d), CONT_COLS, "default_flag", style="py"))
