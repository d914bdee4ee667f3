"""Distribution tails against closed forms and numerical integrals."""

import math

import numpy as np
from pyspark.sql import functions as F

from tapewise.functions import special


def evaluated(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_ln_gamma(spark):
    points = [0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 7500.5]
    got = evaluated(spark, *[special.ln_gamma(a) for a in points])
    assert np.allclose(got, [math.lgamma(a) for a in points], rtol=1e-13, atol=1e-13)


def test_chi2(spark):
    points = [0.0, 0.01, 0.5, 1.0, 3.0, 9.0, 40.0, 300.0]
    one = evaluated(spark, *[special.chi2_tail(x, 1) for x in points])
    two = evaluated(spark, *[special.chi2_tail(x, 2) for x in points])
    six = evaluated(spark, *[special.chi2_tail(x, 6) for x in points])
    assert np.allclose(one, [math.erfc(math.sqrt(x / 2)) for x in points], rtol=1e-10, atol=0)
    assert np.allclose(two, [math.exp(-x / 2) for x in points], rtol=1e-10, atol=0)
    assert np.allclose(six, [math.exp(-x / 2) * (1 + x / 2 + x * x / 8) for x in points], rtol=1e-10, atol=0)
    for dof in (1, 2, 5, 40, 2000):
        x = evaluated(spark, special.chi2_quantile(0.95, dof))[0]
        assert abs(evaluated(spark, special.chi2_tail(x, dof))[0] - 0.05) < 1e-10


def test_t(spark):
    points = [0.0, 0.1, 1.0, 2.5, 20.0]
    cauchy = evaluated(spark, *[special.t_tails(t, 1) for t in points])
    assert np.allclose(cauchy, [1 - 2 / math.pi * math.atan(t) for t in points], rtol=1e-10)
    two = evaluated(spark, *[special.t_tails(t, 2) for t in points])
    assert np.allclose(two, [1 - t / math.sqrt(2 + t * t) for t in points], rtol=1e-9)
    near = evaluated(spark, *[special.t_tails(t, special.NORMAL_DOF + d) for t in (0.5, 2.0) for d in (0, 1)])
    assert abs(near[0] - near[1]) < 1e-8 and abs(near[2] - near[3]) < 1e-8


def test_columns_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 2), (4.0, 3), (None, 2), (3.0, None)], "x double, d int")
    got = [r.p for r in df.select(special.chi2_tail(F.col("x"), F.col("d")).alias("p")).collect()]
    assert abs(got[0] - math.exp(-0.5)) < 1e-10 and got[1] is not None and got[2:] == [None, None]
