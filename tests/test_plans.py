"""Physical-plan properties the scale design relies on."""

import contextlib

import pytest

from orebridge import catalog, plans
from orebridge.sources import assay_raw, sensor_raw
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keep_first_limits_rows_before_the_shuffle(spark):
    plan = plan_of(catalog.QUERIES["dedup_keep_first"](spark, SF_SMALL))
    exchange = plan.index("Exchange hashpartitioning(reading_id")
    partial = plan.index("row_number(), 1, Partial")
    assert partial > exchange        # printed below it, i.e. runs before it


def test_join_reuses_the_dedup_partitioning_at_scale(spark):
    with no_broadcast(spark):
        plan = plan_of(plans.reconciliation(*catalog.facts(spark, SF_SMALL)))
    assert "SortMergeJoin [reading_id" in plan
    # one exchange on reading_id for the sensor side (from keep-first), one for the assays
    assert plan.count("Exchange hashpartitioning(reading_id") == 2


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_products(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(catalog.QUERIES["fact_assay"](spark, SF_SMALL))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all("props" not in s and "user_id" not in s for s in schemas)


def _written_inputs(spark, root):
    """Raw sensor and assay rows as files: no predicate of the fixture reaches their scans."""
    sensor_raw(spark, SF_SMALL).write.parquet(f"{root}/sensor")
    assay_raw(spark, SF_SMALL).write.parquet(f"{root}/assay")
    return spark.read.parquet(f"{root}/sensor"), spark.read.parquet(f"{root}/assay")


def test_readings_without_an_assay_leave_before_the_shuffle(spark, tmp_root):
    raw, raw_assay = _written_inputs(spark, tmp_root)
    assay = plans.assay_fact(raw_assay)
    with no_broadcast(spark):
        plan = plan_of(plans.reconciliation(plans.paired_sensor_fact(raw, assay), assay))
    exchange = plan.index("Exchange hashpartitioning(reading_id")
    reduction = plan.index("LeftSemi")
    assert reduction > exchange          # printed below it: runs before it
    assert "BroadcastHashJoin" in plan[reduction - 80:reduction]
    got = plans.reconciliation(plans.paired_sensor_fact(raw, assay), assay)
    want = plans.reconciliation(plans.sensor_fact(raw), assay)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


def test_monthly_view_does_not_shuffle_the_whole_fact_for_its_join(spark, tmp_root):
    raw, raw_assay = _written_inputs(spark, tmp_root)
    plans.sensor_fact(raw).write.parquet(f"{tmp_root}/fact")
    fact, assay = spark.read.parquet(f"{tmp_root}/fact"), plans.assay_fact(raw_assay)
    with no_broadcast(spark):
        plan = plan_of(plans.monthly_grade_trend(fact, assay))
    # two scans of the fact: one aggregated without a join, one reduced before its exchange
    for part in plan.split("Exchange hashpartitioning(reading_id")[1:]:
        below = part.split("Exchange ")[0]
        assert "/fact]" not in below or "LeftSemi" in below


def test_transform_sensor_shuffles_only_statistics(spark, tmp_root):
    raw, _ = _written_inputs(spark, tmp_root)
    plan = plan_of(plans.transform_sensor(raw))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
