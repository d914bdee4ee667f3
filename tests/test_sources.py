"""Sources: CSV tapes with a declared schema, positional renames, blanks, materialised tapes."""

import tempfile

from conftest import SF0001, SF001
from pyspark.sql import functions as F

from tapewise.operators import curves as C
from tapewise.sources import blank_to_null, inline_mapping, labelled_tape, read_tape, rename_all, snake_case


def test_snake_case():
    assert snake_case("FICO Score") == "fico_score"
    assert snake_case("ListingCategory..numeric.") == "listing_category_numeric"
    assert snake_case("default.payment.next.month") == "default_payment_next_month"


def test_csv_tape_round_trip(spark):
    """A tape written as CSV (blanks for missing strings) reads back with a declared schema."""
    t = labelled_tape(spark, SF0001).select("loan_id", "grade", "home_ownership", "apr")
    out = tempfile.mkdtemp(prefix="tapewise-csv-")
    t.withColumn("home_ownership", F.coalesce("home_ownership", F.lit(""))) \
     .write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(out)
    back = read_tape(spark, out, schema="`Loan ID` bigint, `Grade` string, `Home Ownership` string, `APR` double",
                     fmt="csv", normalise_names=True)
    assert back.columns == ["loan_id", "grade", "home_ownership", "apr"]
    back = blank_to_null(back, ["home_ownership"])
    assert back.count() == t.count()
    assert back.filter(F.col("home_ownership").isNull()).count() == t.filter(F.col("home_ownership").isNull()).count()


def test_rename_all_and_inline_mapping(spark):
    m = inline_mapping(spark, {"A": 1, "B": 2}, "grade", "code")
    assert m.schema.simpleString() == "struct<grade:string,code:bigint>"
    r = rename_all(m, ["g", "c"])
    assert r.columns == ["g", "c"]


def test_roc_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    t = labelled_tape(spark, SF001).filter(F.col("apr").isNotNull())
    mine = C.roc_auc(t, "default_flag", "apr").first().auc_roc
    ev = BinaryClassificationEvaluator(rawPredictionCol="apr", labelCol="label", metricName="areaUnderROC", numBins=0)
    theirs = ev.evaluate(t.select(F.col("apr").cast("double"), F.col("default_flag").cast("double").alias("label")))
    assert abs(mine - theirs) < 1e-12
