"""Rule-based portfolios: OR / AND selections, their metrics and dummy flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewise.operators.sets import among, bounded_rows, salted_flag
from tapewise.session import stored


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(or_, predicates)


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(and_, predicates)


def portfolio_any(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """Rows meeting ANY criterion (one predicate; NULL comparisons count as not met)."""
    return df.filter(F.coalesce(any_of(predicates), F.lit(False)))


def portfolio_all(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """Rows meeting ALL criteria."""
    return df.filter(F.coalesce(all_of(predicates), F.lit(False)))


def criteria_predicates(criteria: Mapping[str, Sequence]) -> list[Column]:
    """``{'grade': ['B', 'C'], ...}`` -> membership predicates."""
    return [F.col(k).cast("string").isin([str(v) for v in vals]) for k, vals in criteria.items()]


def edit_criteria(criteria: Mapping[str, Sequence], drop: Sequence[str] = (),
                  override: Mapping[str, Sequence] | None = None) -> dict:
    """Driver-side configuration edit: remove keys, replace value lists."""
    out = {k: list(v) for k, v in criteria.items() if k not in set(drop)}
    out.update({k: list(v) for k, v in (override or {}).items()})
    return out


def portfolio_from_selection(df: DataFrame, selection: DataFrame, fields: Sequence[str],
                             mode: str = "all") -> DataFrame:
    """Portfolio from a ``(field, value)`` selection table (e.g. ``select_alpha_values``).

    ``mode='all'`` keeps rows whose every field has a chosen value, ``mode='any'`` those with at least one.  The
    chosen values are counted first: a bounded set becomes one predicate, a larger one a salted join per field.
    """
    if mode not in ("all", "any"):
        raise ValueError("mode must be 'all' or 'any'")
    sel = selection.select(F.col("field").alias("__f"), F.col("value").alias("__v")).filter(F.col("__f").isin(list(fields)))
    rows = bounded_rows(sel)
    combine = all_of if mode == "all" else any_of
    if rows is not None:
        return df.filter(combine([among(F.col(f).cast("string"), [r["__v"] for r in rows if r["__f"] == f]) for f in fields]))
    sel, out = stored(sel, "selection"), df
    for i, f in enumerate(fields):
        out = salted_flag(out, f, sel.filter(F.col("__f") == F.lit(f)).select("__v"), f"__in{i}")
    flags = [f"__in{i}" for i in range(len(fields))]
    return out.filter(combine([F.col(x) for x in flags])).drop(*flags)


def selected_criteria(selection: DataFrame) -> dict[str, list]:
    """A ``(field, value)`` selection as criteria to edit; an error beyond the bound of a value set."""
    rows = bounded_rows(selection.select("field", "value").orderBy("field", "value"))
    if rows is None:
        raise ValueError("too many chosen values to edit by hand")
    out: dict = {}
    for r in rows:
        out.setdefault(r["field"], []).append(r["value"])
    return out


def portfolio_metrics(df: DataFrame, subset: Column | DataFrame, label: str = "default_flag",
                      apr: str = "apr") -> DataFrame:
    """``n_total, n_subset, default_rate, avg_apr, def_adj_return, pct_picked`` for a subset.

    A predicate subset is one aggregate with conditional sums; a DataFrame
    subset is aggregated on its own and combined with the one-row total.
    """
    if isinstance(subset, DataFrame):
        tot = df.agg(F.count(F.lit(1)).alias("n_total"))
        sub = subset.agg(F.count(F.lit(1)).alias("n_subset"), F.avg(F.col(label).cast("double")).alias("default_rate"),
                         F.avg(apr).alias("avg_apr"))
        j = tot.crossJoin(F.broadcast(sub))  # both sides are one row
    else:
        m = F.coalesce(subset, F.lit(False))
        j = df.agg(
            F.count(F.lit(1)).alias("n_total"),
            F.count_if(m).alias("n_subset"),
            F.try_divide(F.sum(F.when(m, F.col(label))).cast("double"), F.count_if(m).cast("double")).alias("default_rate"),
            F.avg(F.when(m, F.col(apr))).alias("avg_apr"))
    return j.select(
        "n_total", "n_subset", "default_rate", "avg_apr",
        (F.col("avg_apr") - F.lit(100.0) * F.col("default_rate")).alias("def_adj_return"),
        (F.lit(100.0) * F.col("n_subset") / F.col("n_total")).alias("pct_picked"))


def union_dedup(dfs: Sequence[DataFrame]) -> DataFrame:
    """Append selections and drop exact duplicates; rows that share a key but differ all stay."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def membership_flag(df: DataFrame, subset: DataFrame, key: str, out: str = "in_subset") -> DataFrame:
    """1 when the row's key appears in ``subset``; a left join to the subset's distinct keys."""
    keys = subset.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    j = df.join(keys, F.col(key) == F.col("__k"), "left")
    return j.withColumn(out, F.coalesce(F.col("__hit"), F.lit(0))).drop("__k", "__hit")


def criteria_dummies(df: DataFrame, criteria: Mapping[str, Column], combined: str | None = "dmy_all") -> DataFrame:
    """One 0/1 column per named predicate (NULL -> 0) plus their AND as ``combined``."""
    flags = {name: F.coalesce(pred.cast("int"), F.lit(0)) for name, pred in criteria.items()}
    out = df.withColumns(flags)
    if combined:
        out = out.withColumn(combined, F.least(*[F.col(n) for n in criteria]) if len(criteria) > 1
                             else F.col(next(iter(criteria))))
    return out
