import random

import pytest
import statistics
from decimal import Decimal

from orebridge.operators import group_median, impute_group_median, running_total


def test_even_count_median_and_imputation(spark):
    df = spark.createDataFrame(
        [("a", Decimal("1.00")), ("a", Decimal("2.00")), ("a", None)], "g string, t decimal(8,2)")
    filled = sorted(r.t for r in impute_group_median(df, ["g"], "t").collect())
    assert filled == [Decimal("1.00"), Decimal("1.50"), Decimal("2.00")]


def test_midpoint_rounds_half_up_into_column_type(spark):
    df = spark.createDataFrame(
        [("a", Decimal("1.01")), ("a", Decimal("1.02")), ("a", None)], "g string, t decimal(8,2)")
    med = group_median(df, ["g"], "t").first().median
    assert med == Decimal("1.015")
    filled = [r.t for r in impute_group_median(df, ["g"], "t").collect()]
    assert Decimal("1.02") in filled


def test_null_group_and_all_null_group(spark):
    df = spark.createDataFrame(
        [(None, Decimal("3.00")), ("b", None), ("b", None), ("c", Decimal("4.00"))],
        "g string, t decimal(8,2)")
    out = impute_group_median(df, ["g"], "t").collect()
    assert sorted((r.g or "", r.t) for r in out) == [
        ("", None), ("b", None), ("b", None), ("c", Decimal("4.00"))]


def test_skewed_groups_match_pandas_median(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 else rnd.choice(["x", "y", "z"])   # one group holds 2/3 of the rows
        rows.append((g, float(rnd.randint(0, 500)) / 4))
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    want = {}
    for g in {g for g, _ in rows}:
        want[g] = statistics.median(v for gg, v in rows if gg == g)
    for limit in (0, 10_000):   # distributed path, then the checked single-window path
        got = {r.g: r.median for r in group_median(df, ["g"], "v", max_local_rows=limit).collect()}
        assert got == want


@pytest.mark.parametrize("limit", [0, 100])
def test_running_total_numbers_rows_in_order(spark, limit):
    df = spark.createDataFrame([(k,) for k in [5, 3, 9, 1, 7, 2]], "k long").repartition(3)
    got = sorted((r.k, r._before) for r in running_total(df, ["k"], max_local_rows=limit).collect())
    assert got == [(1, 0), (2, 1), (3, 2), (5, 3), (7, 4), (9, 5)]


@pytest.mark.parametrize("limit", [0, 100])
def test_running_total_weighted_by_group(spark, limit):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 1, 4), ("a", 3, 1)],
                               "g string, v long, w long")
    got = sorted((r.g, r.v, r._before, r.total) for r in
                 running_total(df, ["v"], ["g"], weight="w", total="total",
                               max_local_rows=limit).collect())
    assert got == [("a", 1, 0, 6), ("a", 2, 2, 6), ("a", 3, 5, 6), ("b", 1, 0, 4)]


def test_running_total_hot_group_spans_partitions(spark):
    # 3000 rows of one group + a few others, forced onto the distributed path
    rows = [("hot", i) for i in range(3000)] + [("x", i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(6)
    out = running_total(df, ["v"], ["g"], max_local_rows=0)
    assert out.where("g = 'hot' AND _before != v").count() == 0
    assert out.where("g = 'x' AND _before != v").count() == 0


def test_imputation_without_broadcast_uses_salted_join(spark):
    rows = [("hot", None if i % 10 == 0 else Decimal(i % 97)) for i in range(2000)]
    rows += [("x", Decimal("5.00")), ("x", None), (None, Decimal("1.00"))]
    df = spark.createDataFrame(rows, "g string, t decimal(8,2)").repartition(5)
    broadcast = impute_group_median(df, ["g"], "t")
    salted = impute_group_median(df, ["g"], "t", max_broadcast_rows=0)
    assert "__salt" not in salted.columns and salted.columns == df.columns
    assert salted.exceptAll(broadcast).count() == 0 and broadcast.exceptAll(salted).count() == 0
    assert salted.count() == df.count()
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "__salt" in plan
