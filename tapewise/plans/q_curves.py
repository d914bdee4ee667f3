"""Registered queries: confusion tables, accuracy statistics, curves and areas.

The score is the tape's rounded ``apr`` (so no fitted model is needed for an
exact oracle); hard predictions threshold ``revolving_util`` at 0.05.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewise.operators import clean
from tapewise.operators import curves as C
from tapewise.operators import split as S
from tapewise.plans.q_split import hash_sql
from tapewise.plans.registry import query, r6, tape_sql
from tapewise.sources.fixture import labelled_tape

PRED_SQL = "CAST(revolving_util >= 0.05::DOUBLE AS INTEGER)"


def _predicted(spark, d):
    return clean.threshold_predict(labelled_tape(spark, d), "revolving_util", 0.05)


@query("threshold_predict", tape_sql(f"SELECT loan_id, {PRED_SQL} AS prediction FROM loan_tape"))
def q_threshold_predict(spark, d):
    return _predicted(spark, d).select("loan_id", "prediction")


@query("confusion_margins", tape_sql(f""", p AS (SELECT default_flag AS actual, {PRED_SQL} AS predicted FROM loan_tape
           WHERE revolving_util IS NOT NULL),
grid AS (SELECT x.a, y.b FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)),
cells AS (SELECT grid.a AS actual, grid.b AS predicted, count(p.actual) AS n FROM grid
          LEFT JOIN p ON p.actual = grid.a AND p.predicted = grid.b GROUP BY grid.a, grid.b)
SELECT CASE WHEN grouping(actual) = 1 THEN 'Total' ELSE CAST(actual AS VARCHAR) END AS actual,
       CASE WHEN grouping(predicted) = 1 THEN 'Total' ELSE CAST(predicted AS VARCHAR) END AS predicted,
       CAST(sum(n) AS BIGINT) AS n
FROM cells GROUP BY CUBE (actual, predicted)"""))
def q_confusion_margins(spark, d):
    return C.confusion(_predicted(spark, d), "default_flag", "prediction", margins=True)


@query("accuracy_stats", tape_sql(f""", p AS (SELECT default_flag AS y, {PRED_SQL} AS p FROM loan_tape WHERE revolving_util IS NOT NULL),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM p)
SELECT n, tp, fp, fn, tn, {r6('(tp + tn) / n')} AS accuracy,
       {r6('CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END')} AS precision,
       {r6('CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END')} AS recall FROM c"""))
def q_accuracy_stats(spark, d):
    return C.accuracy_stats(_predicted(spark, d), "default_flag", "prediction")


CURVE_CTE = """, sc AS (SELECT apr AS threshold, CAST(sum(default_flag) AS BIGINT) AS pos, CAST(sum(1 - default_flag) AS BIGINT) AS neg
            FROM loan_tape WHERE apr IS NOT NULL GROUP BY apr),
cum AS (SELECT threshold, pos, neg,
               CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
               CAST(sum(pos) OVER () AS DOUBLE) AS P, CAST(sum(neg) OVER () AS DOUBLE) AS N FROM sc),
seg AS (SELECT *, tp - pos AS ptp, fp - neg AS pfp FROM cum)
"""


@query("roc_curve", tape_sql(CURVE_CTE + f"SELECT threshold, tp, fp, {r6('tp / P')} AS tpr, {r6('fp / N')} AS fpr FROM cum"))
def q_roc_curve(spark, d):
    return C.roc_curve(labelled_tape(spark, d), "default_flag", "apr")


@query("pr_curve", tape_sql(
    CURVE_CTE + f"SELECT threshold, tp, fp, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall FROM cum"))
def q_pr_curve(spark, d):
    return C.pr_curve(labelled_tape(spark, d), "default_flag", "apr")


@query("threshold_curve", tape_sql(
    CURVE_CTE + f"SELECT threshold, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall FROM cum"))
def q_threshold_curve(spark, d):
    return C.threshold_curve(labelled_tape(spark, d), "default_flag", "apr")


@query("roc_auc", tape_sql(CURVE_CTE + f"SELECT {r6('sum(neg * (tp + ptp) / 2.0 / (P * N))')} AS auc_roc FROM seg"))
def q_roc_auc(spark, d):
    return C.roc_auc(labelled_tape(spark, d), "default_flag", "apr")


_SEG = "(tp / P - ptp / P) * (tp / (tp + fp) + {p0}) / 2.0"
_PREV = "ptp / (ptp + pfp)"


@query("pr_auc", tape_sql(CURVE_CTE + "SELECT "
       + r6(f"sum(CASE WHEN ptp + pfp = 0 THEN {_SEG.format(p0='1.0')} ELSE {_SEG.format(p0=_PREV)} END)") + " AS pr_auc_one, "
       + r6(f"sum(CASE WHEN ptp + pfp = 0 THEN 0.0 ELSE {_SEG.format(p0=_PREV)} END)") + " AS pr_auc_none, "
       + r6(f"sum(CASE WHEN ptp + pfp = 0 THEN {_SEG.format(p0='tp / (tp + fp)')} ELSE {_SEG.format(p0=_PREV)} END)")
       + " AS pr_auc_first FROM seg"))
def q_pr_auc(spark, d):
    return C.pr_auc(labelled_tape(spark, d), "default_flag", "apr")


@query("average_precision", tape_sql(
    CURVE_CTE + f"SELECT {r6('sum((tp - ptp) / P * tp / (tp + fp))')} AS average_precision FROM seg"))
def q_average_precision(spark, d):
    return C.average_precision(labelled_tape(spark, d), "default_flag", "apr")


@query("threshold_crossing", tape_sql(
    CURVE_CTE + ", pr AS (SELECT threshold, tp / (tp + fp) AS precision, tp / P AS recall FROM cum)\n"
    f"SELECT threshold, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('abs(precision - recall)')} AS gap "
    "FROM pr ORDER BY abs(precision - recall), threshold LIMIT 1"))
def q_threshold_crossing(spark, d):
    curve = C.pr_curve(labelled_tape(spark, d), "default_flag", "apr")
    return C.threshold_crossing(curve)


@query("majority_baseline", tape_sql(
    f", f AS (SELECT CAST({hash_sql(repr('0'))} % 3 AS INTEGER) AS fold, default_flag FROM loan_tape)\n"
    f"SELECT fold, {r6('greatest(avg(default_flag), 1.0 - avg(default_flag))')} AS baseline, count(*) AS n FROM f GROUP BY fold"))
def q_majority_baseline(spark, d):
    f = S.kfold(labelled_tape(spark, d), "loan_id", k=3, seed=0)
    return C.majority_baseline(f, "fold", "default_flag")


@query("auc_hard_labels", tape_sql(
    f""", h AS (SELECT default_flag, CAST({PRED_SQL} AS DOUBLE) AS s FROM loan_tape WHERE revolving_util IS NOT NULL),
sc AS (SELECT s AS threshold, CAST(sum(default_flag) AS BIGINT) AS pos, CAST(sum(1 - default_flag) AS BIGINT) AS neg
       FROM h GROUP BY s),
cum AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
               CAST(sum(pos) OVER () AS DOUBLE) AS P, CAST(sum(neg) OVER () AS DOUBLE) AS N FROM sc)
SELECT {r6('sum(neg * (2 * tp - pos) / 2.0 / (P * N))')} AS auc_roc FROM cum"""))
def q_auc_hard_labels(spark, d):
    """AUC of hard 0/1 predictions (the original scripts' ``roc_curve`` on predicted labels)."""
    p = _predicted(spark, d)
    return C.roc_auc(p, "default_flag", F.col("prediction"))


@query("imbalanced_curve_areas", f"""WITH j AS (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE d.n_chars IS NOT NULL AND l.quality IS NOT NULL),
sc AS (SELECT s AS threshold, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM j GROUP BY s),
cum AS (SELECT threshold, pos, neg,
               CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
               CAST(sum(pos) OVER () AS DOUBLE) AS P, CAST(sum(neg) OVER () AS DOUBLE) AS N FROM sc),
seg AS (SELECT *, tp - pos AS ptp, fp - neg AS pfp FROM cum)
SELECT {r6('sum(neg * (tp + ptp) / 2.0 / (P * N))')} AS auc_roc, """
       + r6(f"sum(CASE WHEN ptp + pfp = 0 THEN {_SEG.format(p0='1.0')} ELSE {_SEG.format(p0=_PREV)} END)") + " AS pr_auc_one, "
       + r6(f"sum(CASE WHEN ptp + pfp = 0 THEN 0.0 ELSE {_SEG.format(p0=_PREV)} END)") + " AS pr_auc_none, "
       + r6(f"sum(CASE WHEN ptp + pfp = 0 THEN {_SEG.format(p0='tp / (tp + fp)')} ELSE {_SEG.format(p0=_PREV)} END)")
       + " AS pr_auc_first, " + r6("sum((tp - ptp) / P * tp / (tp + fp))") + " AS average_precision FROM seg")
def q_imbalanced_curve_areas(spark, d):
    """Curve areas on an imbalanced label (document quality, mostly 1) scored by document length."""
    from tapewise.sources.fixture import read_table

    j = read_table(spark, d, "labels").join(read_table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    j = j.select(F.col("quality").alias("y"), F.col("n_chars").cast("double").alias("s"))
    return C.roc_auc(j, "y", "s").crossJoin(C.pr_auc(j, "y", "s")).crossJoin(C.average_precision(j, "y", "s"))


@query("curve_drop_na", tape_sql(
    CURVE_CTE + f"SELECT threshold, tp, fp, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall FROM cum"))
def q_curve_drop_na(spark, d):
    """A precision-recall curve reported with its origin point (precision undefined), which is then dropped."""
    curve = C.with_origin(C.pr_curve(labelled_tape(spark, d), "default_flag", "apr"))
    return C.curve_drop_na(curve, "precision")
