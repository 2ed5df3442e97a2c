"""Reduced semi-joins, positions, quantile sketches, lookups in repeated keys, and the monthly
view's difference aggregation, against plain versions."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orebridge import plans, schemas
from orebridge.operators import (approximate_median, attach, flag_duplicates, group_median, joins,
                                 median_sketches, merge_sketches, semi_reduce, with_position)

T0 = dt.datetime(2024, 1, 5, 8, 0)


# ---- semi_reduce
def test_semi_reduce_is_exact_for_few_keys(spark):
    big = spark.range(1000).withColumn("v", F.col("id") * 2)
    keys = spark.createDataFrame([(3,), (3,), (None,), (5000,), (7,)], "id long")
    assert sorted(r.id for r in semi_reduce(big, keys, "id").collect()) == [3, 7]


def test_semi_reduce_by_bitmap_keeps_every_wanted_row(spark):
    big = spark.range(20000).withColumnRenamed("id", "k").withColumn("v", F.lit("x"))
    big = big.unionByName(spark.createDataFrame([(None, "n")], "k long, v string"))
    keys = spark.range(0, 20000, 40).withColumnRenamed("id", "k")
    kept = semi_reduce(big, keys, "k", max_rows=0, filter_bits=1 << 17)
    ids = {r.k for r in kept.collect()}
    assert kept.columns == big.columns and set(range(0, 20000, 40)) <= ids and len(ids) < 2000
    # a bitmap that would be more than half full is not used
    assert semi_reduce(big, keys, "k", max_rows=0, filter_bits=1 << 9).count() == 20001
    assert semi_reduce(big, keys.limit(0), "k", max_rows=0).count() == 0


def test_semi_reduce_of_text_keys(spark):
    big = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    keys = big.where("k LIKE '%77'")
    kept = semi_reduce(big, keys, "k", max_rows=0, filter_bits=1 << 16)
    assert kept.intersect(keys).count() == keys.count() and kept.count() < 500


# ---- repeated keys
@pytest.mark.parametrize("salted", [False, True])
def test_transform_flags_like_the_window(spark, monkeypatch, salted):
    """NULL readings are one key; a hot reading; both ways of the lookup join."""
    rng = random.Random(5)
    ids = [None] * 40 + [1] * 300 + [rng.randrange(200) for _ in range(400)]
    rng.shuffle(ids)
    rows = [(n, i, T0, rng.choice(["a", "b", None]), "BENCH-100", Decimal(1), Decimal(1), Decimal("0.5"),
             rng.choice([None, Decimal(10), Decimal(20)])) for n, i in enumerate(ids)]
    raw = spark.createDataFrame(rows, schemas.SENSOR_RAW)
    if salted:
        monkeypatch.setattr(joins, "broadcast_if_bounded", lambda df, max_rows=0: (df, False))
    got = {r.ingest_seq: r.is_duplicate for r in plans.transform_sensor(raw).collect()}
    want = {r.ingest_seq: r.is_duplicate for r in flag_duplicates(raw, ["reading_id"], ["ingest_seq"]).collect()}
    seen, plain = set(), {}
    for n, i in enumerate(ids):
        plain[n] = i in seen
        seen.add(i)
    assert got == want == plain


def test_attach_matches_null_keys_only_if_asked(spark):
    big = spark.createDataFrame([(None, 1), (2, 2)], "k long, v int")
    small = spark.createDataFrame([(None, "n"), (2, "t")], "k long, w string")
    for rows in (0, 10):
        safe = {r.v: r.w for r in attach(big, small, ["k"], null_safe=True, max_rows=rows).collect()}
        plain = {r.v: r.w for r in attach(big, small, ["k"], max_rows=rows).collect()}
        assert safe == {1: "n", 2: "t"} and plain == {1: None, 2: "t"}


def test_statistics_of_one_pass(spark):
    rows = [(1, 1, T0, "a", "B1", Decimal(1), Decimal(1), Decimal("0.5"), Decimal(10)),
            (2, 1, T0 + dt.timedelta(days=1), None, "B2", Decimal(1), Decimal(1), Decimal("0.7"), None),
            (3, 2, None, "b", None, Decimal(1), Decimal(1), None, Decimal(30))]
    stats = plans.raw_statistics(spark.createDataFrame(rows, schemas.SENSOR_RAW), repeated=True)
    assert {r[0] for r in stats.equipment().collect()} == {"a", "b", None}
    assert {r[0] for r in stats.benches().collect()} == {"B1", "B2", None}
    assert {r[0] for r in stats.dates().collect()} == {T0.date(), T0.date() + dt.timedelta(days=1), None}
    assert [tuple(r) for r in stats.repeated().collect()] == [(1, 1)]
    assert {tuple(r) for r in stats.medians().collect()} == {("a", Decimal(10)), ("b", Decimal(30))}
    assert round(stats.bounds().first()["mean"], 9) == 0.6
    nothing = spark.createDataFrame([], schemas.SENSOR_RAW)
    empty = plans.raw_statistics(nothing, repeated=True)
    assert empty.equipment().count() == empty.repeated().count() == empty.bounds().count() == 0
    assert plans.transform_sensor(nothing, stats=empty).count() == 0


# ---- monthly view
def test_monthly_difference_equals_the_left_join(spark):
    rng = random.Random(8)
    fact = [(i, T0 + dt.timedelta(days=rng.randrange(90)), "e", rng.choice(["b1", "b2", None]), Decimal(1), Decimal(1),
             rng.choice([None, Decimal(rng.randrange(9999)) / 10000]), rng.choice([None, Decimal(rng.randrange(9999)) / 100]),
             False, False, rng.choice([True, True, True, False, None])) for i in range(400)]
    assays = [(n, rng.choice([None, rng.randrange(450)]), T0, T0, rng.choice([None, Decimal(rng.randrange(9999)) / 10000]),
               Decimal(2)) for n in range(300)]
    sensor = spark.createDataFrame(fact, spark.createDataFrame([], schemas.FACT_SENSOR).drop("loaded_at").schema)
    assay = spark.createDataFrame(assays, spark.createDataFrame([], schemas.FACT_ASSAY).drop("loaded_at").schema)
    sensor.createOrReplaceTempView("t_sensor")
    assay.createOrReplaceTempView("t_assay")
    want = spark.sql("""
        SELECT CAST(trunc(to_date(s.timestamp), 'month') AS TIMESTAMP_NTZ) AS month, bench_id, count(*) AS total_loads,
               round(sum(sensor_cu_grade) / nullif(count(sensor_cu_grade), 0), 4) AS avg_sensor_grade,
               round(sum(assay_cu_grade) / nullif(count(assay_cu_grade), 0), 4) AS avg_assay_grade,
               round(sum(tonnage), 0) AS total_tonnage,
               round(sum(tonnage) * sum(sensor_cu_grade) / nullif(count(sensor_cu_grade) * 100, 0), 2) AS estimated_cu_tons
        FROM t_sensor s LEFT JOIN t_assay a ON s.reading_id = a.reading_id WHERE qc_passed GROUP BY 1, 2""")
    got = plans.monthly_grade_trend(sensor, assay)
    assert got.columns == want.columns
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    none = plans.monthly_grade_trend(sensor.limit(0), assay)
    assert none.count() == 0


# ---- positions
@pytest.mark.parametrize("max_local_rows", [0, 1000])
def test_positions_follow_the_order(spark, max_local_rows):
    rng = random.Random(2)
    values = [(n, rng.choice([None, *range(5)]), rng.choice(["x", "y", None])) for n in range(300)]
    df = spark.createDataFrame(values, "n int, v int, w string").repartition(7)
    order = [F.col("v").desc_nulls_last(), F.col("w").asc_nulls_first(), F.col("n").asc()]
    got = with_position(df, order, max_local_rows=max_local_rows)
    place = sorted(values, key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or "", r[0]))
    assert {r.n: r.position for r in got.collect()} == {r[0]: k + 1 for k, r in enumerate(place)}
    assert with_position(df.limit(0), order, max_local_rows=max_local_rows).count() == 0


# ---- sketches
def test_merged_sketches_stay_near_the_exact_median(spark):
    df = spark.range(60000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 7).alias("load"),
                                   (F.hash("id") % 100000).cast("decimal(12,2)").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 1, Decimal(5)), ("0", 1, None), ("only null", 2, None)],
                                              "g string, load long, v decimal(12,2)"))
    merged = merge_sketches(median_sketches(df, ["g", "load"], "v"), ["g"])
    assert {r.g: r.n_values for r in merged.collect()} == {"0": 20000, "1": 20000, "2": 20000}
    near = {r.g: r.median for r in approximate_median(merged, ["g"]).collect()}
    exact = {r.g: float(r.median) for r in group_median(df, ["g"], "v").collect()}
    assert set(near) == set(exact)
    for g, value in near.items():
        below = df.where((F.col("g") == g) & (F.col("v") <= value)).count()
        assert abs(below / 20000 - 0.5) < 0.005
    assert max(r[0] for r in merged.select(F.octet_length("sketch")).collect()) < 200_000
