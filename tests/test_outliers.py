from decimal import Decimal

from orebridge.operators import flag_outliers, sigma_bounds


def test_null_grade_is_not_outlier(spark):
    df = spark.createDataFrame([(Decimal("1.0"),), (None,), (Decimal("1.2"),)], "g decimal(6,4)")
    assert [r.is_outlier for r in flag_outliers(df, "g").collect()] == [False, False, False]


def test_single_row_bounds(spark):
    df = spark.createDataFrame([(Decimal("0.5"),)], "g decimal(6,4)")
    b = sigma_bounds(df, "g").first()
    assert b.upper_limit is None and b.lower_limit == 0.0
    assert flag_outliers(df, "g").first().is_outlier is False


def test_strict_limits(spark):
    # mean 2, sample std 1 -> bounds with k=1 are [1, 3]; values on a limit are inside
    df = spark.createDataFrame([(Decimal(x),) for x in ["1", "2", "3"]], "g decimal(6,4)")
    assert [r.is_outlier for r in flag_outliers(df, "g", k=1.0).collect()] == [False] * 3
    df2 = spark.createDataFrame([(Decimal(x),) for x in ["0.5", "3.5"]], "g decimal(6,4)")
    flags = [r.is_outlier for r in flag_outliers(df2, "g", k=1.0, bounds_from=df).collect()]
    assert flags == [True, True]


def test_lower_limit_floored_at_zero(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ["0.1", "5.0", "0.2"]], "g decimal(6,4)")
    assert sigma_bounds(df, "g").first().lower_limit == 0.0
