import contextlib
import io

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import (age_group, avg_half_up, engagement_score, half_up,
                                 register_sql_functions, share_pct)


def test_half_up_ties_and_signs(spark):
    df = spark.createDataFrame([(5, 100), (15, 100), (25, 100), (-5, 100), (-15, 100), (1, 3), (2, 3),
                                (7, 0)], "n long, d long")
    got = [r[0] for r in df.select(half_up("n", "d", 1)).collect()]
    assert got == [0.1, 0.2, 0.3, -0.1, -0.2, 0.3, 0.7, None]


def test_avg_half_up_is_exact_mean(spark):
    # mean 60.75 is a tie at 1 dp: HALF_UP gives 60.8 whatever the summation order
    df = spark.createDataFrame([(60.5,), (61.0,), (60.5,), (61.0,)], "x double")
    assert df.agg(avg_half_up("x", 1, 1)).first()[0] == 60.8
    df2 = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert df2.agg(avg_half_up("x", 0, 2)).first()[0] == 1.67
    empty = spark.createDataFrame([], "x int")
    assert empty.agg(avg_half_up("x", 0, 2)).first()[0] is None


def test_share_pct(spark):
    df = spark.createDataFrame([(1, 3), (2, 3)], "p long, t long")
    assert [r[0] for r in df.select(share_pct("p", "t")).collect()] == [33.3, 66.7]


@pytest.mark.parametrize("age,band", [(None, "45+"), (10, "18-24"), (18, "18-24"), (24, "18-24"),
                                      (25, "25-34"), (34, "25-34"), (35, "35-44"), (44, "35-44"),
                                      (45, "45+"), (99, "45+")])
def test_age_group(spark, age, band):
    df = spark.createDataFrame([(age,)], "age int")
    assert df.select(age_group("age")).first()[0] == band


@pytest.mark.parametrize("pct,mins,score", [(85.0, 127, 91.0), (100.0, 121, 100.0), (100.0, 120, 100.0),
                                            (80.0, 0, 48.0), (50.0, 60, 50.0), (49.9, 60, 49.9),
                                            (0.0, 0, 0.0)])
def test_engagement_score_golden(spark, pct, mins, score):
    df = spark.createDataFrame([(pct, mins)], "p double, m int")
    assert df.select(engagement_score("p", "m")).first()[0] == score


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT age_group(NULL), age_group(30), engagement_level(80D), "
                    "engagement_level(49.9D), engagement_score(85D, 127)").first()
    assert tuple(row) == ("45+", "25-34", "HIGH", "LOW", 91.0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.sql("SELECT age_group(30)").explain(True)
    assert "PythonUDF" not in buf.getvalue() and "BatchEvalPython" not in buf.getvalue()


def test_averages_at_any_scale_and_with_nan(spark):
    from reelhouse.functions import avg_half_up, sum_scaled
    df = spark.createDataFrame([(0.05,), (0.04,), (float("nan"),), (None,)], "x double")
    assert df.agg(avg_half_up("x", 1, 1).alias("a")).first()["a"] == 0.0
    assert df.agg(avg_half_up("x", 1, 2).alias("a"), sum_scaled("x", 1).alias("s")).first() == (0.05, 0.09)
    big = spark.range(1000).selectExpr("99999999999.999999D AS x")
    assert big.agg(avg_half_up("x", 1, 2).alias("a")).first()["a"] == 100000000000.0


def test_one_engagement_level_with_nan(spark):
    from reelhouse.functions import columns as C
    from reelhouse.functions.sql import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([(float("nan"),), (85.0,), (60.0,), (None,)], "p double")
    got = df.select(C.engagement_level("p").alias("a"), F.expr("engagement_level(p)").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == ["LOW", "HIGH", "MEDIUM", "LOW"]
