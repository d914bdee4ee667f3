"""Association with default: Cramer's V, point-biserial and Pearson matrices.

All fields are handled in one job: the categorical fields are unpivoted to
``(field, value, label)`` and counted once; the continuous fields are
unpivoted to ``(field, x, label)`` and reduced with moment aggregates.  The
distribution tails (chi-square, Student t) are evaluated afterwards on the
few result rows (one per field) with the commons-math classes that ship
with Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewise.functions import special

from tapewise.operators.profile import unpivot


def _cells(df: DataFrame, cats: Sequence[str], label: str) -> DataFrame:
    long = unpivot(df, cats, keep=[label]).filter(F.col("value").isNotNull() & F.col(label).isNotNull())
    return long.groupBy("field", "value", label).agg(F.count(F.lit(1)).alias("o"))


def chi_square_table(df: DataFrame, cats: Sequence[str], label: str, yates: bool = False) -> DataFrame:
    """Per field: ``k`` levels, ``m`` label levels, ``n`` rows in the table, chi-square statistic.

    Expected counts use true division on the table margins.  With
    ``yates=True`` the continuity correction is applied to 2 x 2 tables only,
    with the correction capped at |o - e| per cell.
    """
    cells = _cells(df, cats, label)
    rows_t = cells.groupBy("field", "value").agg(F.sum("o").alias("r"))
    cols_t = cells.groupBy("field", label).agg(F.sum("o").alias("c"))
    dims = cells.groupBy("field").agg(
        F.sum("o").alias("n"), F.count_distinct("value").alias("k"), F.count_distinct(label).alias("m"))
    # cols_t and dims have one row per (field, label level) and per field: bounded, broadcast,
    # so no field's levels are funnelled into one task by a join on "field"
    grid = rows_t.join(F.broadcast(cols_t), "field").join(cells, ["field", "value", label], "left") \
                 .join(F.broadcast(dims), "field") \
                 .withColumn("o", F.coalesce(F.col("o"), F.lit(0)))
    e = F.col("r").cast("double") * F.col("c").cast("double") / F.col("n").cast("double")
    diff = F.abs(F.col("o") - e)
    if yates:
        corr = F.when((F.col("k") == 2) & (F.col("m") == 2), F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0))
        term = F.pow(diff - corr, 2) / e
    else:
        term = F.pow(diff, 2) / e
    return grid.groupBy("field", "k", "m", "n").agg(F.sum(term).alias("chi2"))


def cramers_v(df: DataFrame, cats: Sequence[str], label: str = "default_flag", style: str = "py") -> DataFrame:
    """Cramer's V of each categorical field against the label.

    ``style='py'``: ``field, k, m, n, chi2, dof_ref, dof_std, v_ref, v_std`` where
    ``v_ref = sqrt(chi2/n / min(k, m))`` and ``dof_ref = k + m - 1`` are the
    original script's formulas and ``v_std``/``dof_std`` the textbook ones
    (``min(k, m) - 1`` and ``(k-1)(m-1)``).  n counts rows with both values.

    ``style='r'``: ``field, k, n_rows, chi2, v`` with the continuity-corrected
    statistic on 2 x 2 tables, ``k`` counting NULL as a level and ``n_rows``
    all rows, V rounded to 3 places.
    """
    if style == "py":
        t = chi_square_table(df, cats, label, yates=False)
        mn = F.least(F.col("k"), F.col("m")).cast("double")
        return t.select(
            "field", "k", "m", "n", "chi2",
            (F.col("k") + F.col("m") - 1).alias("dof_ref"),
            ((F.col("k") - 1) * (F.col("m") - 1)).alias("dof_std"),
            F.sqrt(F.col("chi2") / F.col("n") / mn).alias("v_ref"),
            F.sqrt(F.try_divide(F.col("chi2") / F.col("n"), mn - 1)).alias("v_std"))
    if style == "r":
        t = chi_square_table(df, cats, label, yates=True)
        long = unpivot(df, cats, keep=[label])
        levels = long.groupBy("field").agg(
            (F.count_distinct("value") + F.max(F.col("value").isNull().cast("int"))).alias("k_all"),
            F.count(F.lit(1)).alias("n_rows"))
        m_all = df.agg(F.count_distinct(label).alias("m_all"))
        j = t.join(levels, "field").crossJoin(F.broadcast(m_all))
        v = F.sqrt(F.col("chi2") / F.col("n_rows") / F.least(F.col("k_all"), F.col("m_all")).cast("double"))
        return j.select("field", F.col("k_all").alias("k"), "n_rows", "chi2", F.round(v, 3).alias("v"))
    raise ValueError("style must be 'py' or 'r'")


def add_chi2_pvalues(result: DataFrame, chi2: str = "chi2", dof: str = "dof_ref", q: float = 0.95) -> DataFrame:
    """Append ``crit`` (chi-square quantile at ``q``) and ``p_value`` (upper tail); NULL without degrees of freedom."""
    known = (F.col(dof) > 0) & F.col(chi2).isNotNull()
    d = F.when(known, F.col(dof))
    return result.withColumns({"crit": special.chi2_quantile(q, d), "p_value": special.chi2_tail(F.col(chi2), d)})


def point_biserial(df: DataFrame, conts: Sequence[str], label: str = "default_flag", style: str = "py") -> DataFrame:
    """Correlation of each continuous field with the 0/1 label (rows with both values).

    ``style='py'``: Pearson r (``field, n, r``), highest first.
    ``style='r'``: the level-1 biserial form ``(mean(x|y=0) - mean(x|y=1)) *
    sqrt(p0 (1 - p0)) / sd(x)`` with the n-1 standard deviation
    (``field, n, r_biserial``); it equals ``-r * sqrt((n-1)/n)``.
    """
    long = unpivot(df, conts, keep=[label], value_type="double") \
        .filter(F.col("value").isNotNull() & F.col(label).isNotNull())
    x = F.col("value")
    y = F.col(label).cast("double")
    if style == "py":
        agg = long.groupBy("field").agg(
            F.count(F.lit(1)).alias("n"),
            F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias("r"))
        return agg.orderBy(F.desc_nulls_last("r"), "field")
    if style == "r":
        is0 = F.col(label) == 0
        agg = long.groupBy("field").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.when(is0, x)).alias("__m0"),
            F.avg(F.when(~is0, x)).alias("__m1"),
            F.avg(is0.cast("double")).alias("__p0"),
            F.stddev_samp(x).alias("__sd"))
        r = F.try_divide((F.col("__m0") - F.col("__m1")) * F.sqrt(F.col("__p0") * (1 - F.col("__p0"))), F.col("__sd"))
        return agg.select("field", "n", r.alias("r_biserial"))
    raise ValueError("style must be 'py' or 'r'")


def add_t_pvalues(result: DataFrame, r: str = "r", n: str = "n") -> DataFrame:
    """Two-sided p-value of a Pearson r via t = r sqrt((n-2)/(1-r^2)) on n-2 degrees of freedom; NULL below 3 rows."""
    rv, dof = F.col(r), F.when(F.col(n) > 2, F.col(n) - 2)
    t = F.sqrt(rv * rv * dof / F.when(F.abs(rv) < 1, 1 - rv * rv))
    tail = F.when(rv.isNull() | dof.isNull(), F.lit(None)).when(F.abs(rv) >= 1, F.lit(0.0)).otherwise(special.t_tails(t, dof))
    return result.withColumn("p_value", tail.cast("double"))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 1) -> DataFrame:
    """Listwise-complete Pearson matrix in long form ``field_a, field_b, r, r_rounded``.

    One aggregate computes every pair; zero-variance fields give NULL.
    """
    cols = list(cols)
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    aggs = []
    pairs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            name = f"c_{i}_{j}"
            pairs.append((a, b, name))
            if i == j:
                aggs.append(F.when(F.stddev_pop(F.col(a)) > 0, F.lit(1.0)).alias(name))
            else:
                aggs.append(F.try_divide(F.covar_pop(F.col(a), F.col(b)),
                                         F.stddev_pop(F.col(a)) * F.stddev_pop(F.col(b))).alias(name))
    wide = complete.agg(*aggs)
    entries = []
    for a, b, name in pairs:
        entries.append(f"'{a}', '{b}', {name}")
        if a != b:
            entries.append(f"'{b}', '{a}', {name}")
    long = wide.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) AS (field_a, field_b, r)")
    return long.withColumn("r_rounded", F.round(F.col("r"), digits))
