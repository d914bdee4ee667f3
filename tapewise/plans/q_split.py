"""Registered queries: splits, folds and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewise.operators import split as S
from tapewise.plans.registry import query, r6, tape_sql
from tapewise.sources.fixture import labelled_tape


def hash_sql(seed_expr: str, key: str = "loan_id") -> str:
    """DuckDB twin of ``hash_int``."""
    return f"('0x' || substr(md5({seed_expr} || ':' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


def unit_sql(seed: int) -> str:
    return f"(CAST({hash_sql(repr(str(seed)))} AS DOUBLE) / 4294967296.0::DOUBLE)"


SPLIT_SQL = f"CASE WHEN {unit_sql(3)} < 0.2::DOUBLE THEN 'test' ELSE 'train' END"


@query("random_split", tape_sql(f"SELECT loan_id, {SPLIT_SQL} AS part FROM loan_tape"))
def q_random_split(spark, d):
    return S.random_split(labelled_tape(spark, d), "loan_id", 0.2, seed=3).select("loan_id", "part")


@query("random_split_exact", tape_sql(
    f"""SELECT loan_id, CASE WHEN row_number() OVER (ORDER BY {hash_sql("'3'")}, loan_id)
                       <= floor(count(*) OVER () * 0.2::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS part
FROM loan_tape"""))
def q_random_split_exact(spark, d):
    return S.random_split(labelled_tape(spark, d), "loan_id", 0.2, seed=3, exact=True).select("loan_id", "part")


@query("stratified_split", tape_sql(
    f"""SELECT loan_id, default_flag,
  CASE WHEN row_number() OVER (PARTITION BY default_flag ORDER BY {hash_sql("'123'")}, loan_id)
            <= floor(count(*) OVER (PARTITION BY default_flag) * 0.2::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS part
FROM loan_tape"""))
def q_stratified_split(spark, d):
    t = S.stratified_split(labelled_tape(spark, d), "loan_id", "default_flag", 0.2, seed=123, exact=True)
    return t.select("loan_id", "default_flag", "part")


@query("kfold", tape_sql(f"SELECT loan_id, CAST({hash_sql(repr('0'))} % 3 AS INTEGER) AS fold FROM loan_tape"))
def q_kfold(spark, d):
    return S.kfold(labelled_tape(spark, d), "loan_id", k=3, seed=0).select("loan_id", "fold")


@query("kfold_exact", tape_sql(
    f"SELECT loan_id, CAST((row_number() OVER (ORDER BY {hash_sql(repr('0'))}, loan_id) - 1) % 3 AS INTEGER) AS fold FROM loan_tape"))
def q_kfold_exact(spark, d):
    return S.kfold(labelled_tape(spark, d), "loan_id", k=3, seed=0, exact=True).select("loan_id", "fold")


@query("repeated_kfold", tape_sql(
    f"SELECT loan_id, CAST(r.rep AS INTEGER) AS repeat, "
    f"CAST({hash_sql('CAST(0 + r.rep AS VARCHAR)')} % 4 AS INTEGER) AS fold FROM loan_tape CROSS JOIN range(4) r(rep)"))
def q_repeated_kfold(spark, d):
    return S.repeated_kfold(labelled_tape(spark, d), "loan_id", k=4, repeats=4, seed=0).select("loan_id", "repeat", "fold")


@query("complement_split", tape_sql(f"SELECT loan_id FROM loan_tape WHERE NOT ({unit_sql(3)} < 0.2::DOUBLE)"))
def q_complement_split(spark, d):
    t = labelled_tape(spark, d)
    test = S.random_split(t, "loan_id", 0.2, seed=3).filter(F.col("part") == "test")
    return S.complement_split(t, test, "loan_id").select("loan_id")


SCALE_COLS = ["apr", "dti", "annual_income"]


def _scale_sql() -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.5) AS q2_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                   for c in SCALE_COLS)
    sel = ", ".join(
        r6(f"({c} - q2_{c}) / CASE WHEN q3_{c} - q1_{c} = 0 THEN 1.0 ELSE q3_{c} - q1_{c} END") + f" AS {c}"
        for c in SCALE_COLS)
    return tape_sql(f""", sp AS (SELECT *, {SPLIT_SQL} AS part FROM loan_tape),
st AS (SELECT {qs} FROM sp WHERE part = 'train')
SELECT loan_id, part, {sel} FROM sp, st""")


@query("robust_scale", _scale_sql())
def q_robust_scale(spark, d):
    t = S.random_split(labelled_tape(spark, d), "loan_id", 0.2, seed=3)
    out = S.robust_scale(t, SCALE_COLS, fit_on=F.col("part") == "train")
    return out.select("loan_id", "part", *SCALE_COLS)
