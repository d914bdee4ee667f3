"""Registry of named queries (Spark builders) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tapewise.operators.profile import round_doubles
from tapewise.sources.fixture import LOAN_TAPE_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

ROUND = 6


def query(name: str, sql: str | None = None, round_digits: int | None = ROUND):
    """Register ``fn(spark, sf_dir) -> DataFrame``; doubles are rounded so engines compare equal."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df, round_digits) if round_digits is not None else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def tape_sql(body: str) -> str:
    """Prefix the loan-tape CTEs; ``body`` is either ``SELECT ...`` or ``, cte AS (...) SELECT ...``."""
    return LOAN_TAPE_SQL + body


def r6(expr: str, digits: int = ROUND) -> str:
    return f"round({expr}, {digits})"


def union_long(cols: Sequence[str], select_fmt: str, source: str = "loan_tape") -> str:
    """``SELECT <fmt with {c}> FROM source UNION ALL ...`` over the columns."""
    parts = [f"SELECT {select_fmt.format(c=c)} FROM {source}" for c in cols]
    return "\nUNION ALL\n".join(parts)
