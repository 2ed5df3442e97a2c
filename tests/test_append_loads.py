"""Several loads from the same raw rows: what is computed once, and the key checks of a load."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from orebridge import catalog, plans, schemas
from orebridge.operators import KeyCheckError, key_usage
from orebridge.plans import sensor as sensor_plans
from orebridge.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


def _reading(reading_id, seq, tonnage="10.0", bench="BENCH-100", day=1):
    return (seq, reading_id, dt.datetime(2024, 1, day, 8), "E1", bench, Decimal("1.00"), Decimal("2.00"),
            Decimal("0.5000"), None if tonnage is None else Decimal(tonnage))


def _raw(spark, rows):
    return spark.createDataFrame(rows, schemas.SENSOR_RAW)


def _assays(spark, *pairs):
    day = dt.datetime(2024, 1, 1, 8)
    rows = [(a, r, day, day + dt.timedelta(days=2), Decimal("0.5000")) for a, r in pairs]
    return plans.assay_fact(spark.createDataFrame(rows, schemas.ASSAY_RAW))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


ONCE = [_reading(1, 1), _reading(2, 2, None), _reading(3, 3), _reading(1, 9, "99.0"), _reading(None, 4), _reading(None, 5)]
TIES = {"twice": [_reading(3, 3)], "three copies": [_reading(2, 2, None), _reading(2, 2, None)],
        "without a number": [_reading(4, None), _reading(4, None)]}


def test_first_readings_are_looked_up_without_a_shuffle(spark):
    raw = _raw(spark, ONCE)
    fact = plans.first_sensor_fact(raw, plans.raw_statistics(raw, repeated=True))
    assert "Exchange hashpartitioning" not in _plan(fact) and "Window" not in _plan(fact)
    assert _rows(fact) == _rows(plans.sensor_fact(raw))


@pytest.mark.parametrize("more", TIES)
def test_one_row_stays_where_several_arrive_first(spark, more):
    raw = _raw(spark, ONCE + TIES[more])
    stats = plans.raw_statistics(raw, repeated=True)
    assert not stats.first_is_unique(raw)
    assert _rows(plans.first_sensor_fact(raw, stats)) == _rows(plans.sensor_fact(raw))


def test_loads_in_two_steps_share_one_pass_of_statistics(spark, monkeypatch):
    calls = {"statistics": 0}
    counted = sensor_plans.raw_statistics

    def statistics(*args, **kwargs):
        calls["statistics"] += 1
        return counted(*args, **kwargs)

    def keep_first(*args):
        raise AssertionError("all readings would be shuffled in every load")
    monkeypatch.setattr(sensor_plans, "keep_first", keep_first)
    for module in (sensor_plans, plans, plans.etl):
        monkeypatch.setattr(module, "raw_statistics", statistics)
    got = {r.table_name: (r.stored_rows, r.n_loads, r.n_rejected)
           for r in catalog.QUERIES["append_row_counts"](spark, SF_SMALL).collect()}
    assert calls["statistics"] == 1
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert got["fact_sensor_readings"] == (events.select("event_id").distinct().count(), 2, 1)


def test_key_usage_counts_the_rows_of_each_frame(spark):
    a = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    b = spark.createDataFrame([(2,), (3,), (None,)], "k long")
    got = {r.k: (r.a, r.b) for r in key_usage({"a": a, "b": b}, ["k"]).collect()}
    assert got == {1: (2, 0), 2: (1, 1), 3: (0, 1), None: (2, 1)}


def _rejection(spark, wh, stored, new, assays, mode):
    fact = plans.sensor_fact(_raw(spark, stored))
    dims = (plans.build_dim_equipment(fact), plans.build_dim_location(fact), plans.build_dim_time(fact, assays))
    wh.load_facts(fact, _assays(spark, (1, stored[0][1])), mode="overwrite",
                  dims=wh.stage_dimensions(*dims, mode="overwrite"))
    sensor = plans.transform_sensor(_raw(spark, new)).select(*schemas.SENSOR_FACT_COLUMNS)
    if not mode:
        return wh._failed_readings(sensor, assays, False)
    with pytest.raises(KeyCheckError) as found:
        wh.load_facts(sensor, assays, mode=mode, dims=None)
    return sorted(re.split(r"; (?=fact_)", str(found.value)))


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_reading_checks_say_the_same_with_and_without_buckets(spark, tmp_root, mode):
    stored = [_reading(1, 1), _reading(2, 2), _reading(9, 3)]
    new = [_reading(1, 11), _reading(2, 12), _reading(2, 13), _reading(5, 14), _reading(5, 15), _reading(None, 16),
           _reading(6, 17)]
    assays = _assays(spark, (21, 6), (22, 9), (23, 77), (24, 78), (25, 78))
    said = {n: _rejection(spark, Warehouse(spark, f"{tmp_root}/{mode}{n}", buckets=n), stored, new, assays, mode)
            for n in (None, 2)}
    assert said[None] == said[2]
    clash = [s for s in said[None] if "keys already stored" in s]
    orphans = next(s for s in said[None] if "reading_id not in" in s)
    if mode == "append":
        assert clash == ["""fact_sensor_readings: keys already stored: 3 rows, e.g. ['{"reading_id":1}', '{"reading_id":2}']"""]
        assert ": 2 rows" in orphans and '{"reading_id":78,"n_rows":2}' in orphans
    else:
        assert not clash and ": 3 rows" in orphans
    assert any("duplicate or NULL keys: 3 rows" in s and '{"n_rows":1}' in s for s in said[None])


def test_reading_checks_shuffle_the_keys_once(spark, tmp_root):
    stored, new = [_reading(1, 1), _reading(2, 2)], [_reading(1, 11), _reading(6, 17)]
    wh = Warehouse(spark, f"{tmp_root}/once")
    found = _rejection(spark, wh, stored, new, _assays(spark, (21, 6)), None)
    assert _plan(found).count("Exchange hashpartitioning(reading_id") == 1
    assert [(r.check.split(": ")[1], r.n) for r in found.collect()] == [("keys already stored", 1)]
