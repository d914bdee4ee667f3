"""Reusable ``Column`` expressions.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage code generation; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 4294967296.0  # 2**32, range of ``hash_int``


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_label_expr(status: str | Column, good: Iterable[str]) -> Column:
    """0 when the status is in the good set, else 1.

    A NULL status is a default (the ``else`` branch of the original loop),
    so the membership test is coalesced to false before the ``when``.
    """
    good = list(good)
    return F.when(F.coalesce(as_column(status).isin(good), F.lit(False)), F.lit(0)).otherwise(F.lit(1))


def cut_expr(c: str | Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """Right-closed intervals ``(a, b]``; values outside every interval -> NULL.

    ``labels`` defaults to interval strings such as ``(0,0.15]``.  This is an
    explicit ``when`` chain rather than ``Bucketizer`` because the latter uses
    left-closed bins.
    """
    col = as_column(c)
    edges = list(edges)
    if len(edges) < 2:
        raise ValueError("cut_expr needs at least two edges")
    if labels is None:
        labels = [f"({_fmt_edge(a)},{_fmt_edge(b)}]" for a, b in zip(edges[:-1], edges[1:])]
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    out = None
    for a, b, lab in zip(edges[:-1], edges[1:], labels):
        cond = (col > F.lit(a)) & (col <= F.lit(b))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def _fmt_edge(x: float) -> str:
    return f"{x:g}"


def safe_log_expr(c: str | Column) -> Column:
    """Natural log; 0 -> 0.0 (the intended infinite-to-zero rule); negative -> NULL."""
    col = as_column(c).cast("double")
    return F.when(col > 0, F.log(col)).when(col == 0, F.lit(0.0))


def floor_zero_expr(c: str | Column) -> Column:
    """Values <= 0 become 0; NULL stays NULL."""
    col = as_column(c)
    return F.when(col <= 0, F.lit(0)).otherwise(col)


def flag_expr(c: str | Column, value) -> Column:
    """1 when the column equals ``value``, else 0 (NULL -> 0)."""
    return F.coalesce((as_column(c) == F.lit(value)).cast("int"), F.lit(0))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` that yields NULL instead of raising on a zero divisor (ANSI mode)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def format_percent_expr(c: str | Column, digits: int = 2) -> Column:
    """Fraction -> ``'12.34%'`` (presentation column only)."""
    x = as_column(c)
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f%%", x * F.lit(100.0)))


def hash_int(key: str | Column, seed: int | str) -> Column:
    """Seeded 32-bit hash of a key as a non-negative BIGINT in [0, 2**32).

    First 8 hex digits of ``md5('<seed>:<key>')``.  The same value is
    computed by any SQL engine with md5 and hex parsing, which makes splits
    and folds reproducible outside Spark.
    """
    text = F.concat(F.lit(f"{seed}:"), as_column(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_unit(key: str | Column, seed: int | str) -> Column:
    """``hash_int`` scaled to a double in [0, 1)."""
    return hash_int(key, seed) / F.lit(HASH_SPACE)


def hash_bucket(key: str | Column, seed: int | str, n: int) -> Column:
    """``hash_int`` modulo ``n``."""
    return F.pmod(hash_int(key, seed), F.lit(n)).cast("int")
