import datetime as dt
from decimal import Decimal

import pytest

from orebridge import plans, schemas
from orebridge.operators import KeyCheckError
from orebridge.plans.warehouse import Warehouse
from orebridge.sources import assay_raw, sensor_raw
from tests.conftest import SF_SMALL


def test_full_refresh_then_reload_is_idempotent_for_dims(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    raw_s, raw_a = sensor_raw(spark, SF_SMALL), assay_raw(spark, SF_SMALL)
    counts = plans.run_etl(raw_s, raw_a, wh, refresh=True)
    assert counts["fact_sensor_readings"] == plans.sensor_fact(raw_s).count()
    assert counts["fact_assay_results"] == raw_a.count()
    # a second refresh gives the same tables
    plans.run_etl(raw_s, raw_a, wh, refresh=True)
    assert wh.row_count("fact_sensor_readings") == counts["fact_sensor_readings"]
    # an append of the same facts clashes on the primary key and writes nothing
    with pytest.raises(KeyCheckError):
        plans.run_etl(raw_s, raw_a, wh, refresh=False)
    assert wh.row_count("fact_sensor_readings") == counts["fact_sensor_readings"]
    # column defaults at load: load / creation timestamps filled on every row
    assert wh.table("fact_sensor_readings").where("loaded_at IS NULL").count() == 0
    assert wh.table("dim_location").where("created_at IS NULL").count() == 0
    views = wh.register_views()
    assert spark.table(wh.catalog_name("v_equipment_kpis")).count() == views["equipment_kpis"].count() > 0


def test_dimension_reload_keeps_old_rows(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.create()
    eq = "equipment_id string, equipment_type string, model string, capacity_tons decimal(8,2), active boolean"
    loc = "bench_id string, bench_elevation int, zone string"
    tim = ("full_date date, year int, quarter int, month int, month_name string, week int, "
           "day_of_week int, shift string")
    d1 = dt.date(2024, 1, 1)
    first = (spark.createDataFrame([("s1", "SHOVEL", "m1", Decimal("1"), True)], eq),
             spark.createDataFrame([("B2", 1, "Z")], loc),
             spark.createDataFrame([(d1, 2024, 1, 1, "January", 1, 0, "DIA")], tim))
    wh.load_dimensions(*first)
    second = (spark.createDataFrame([("s1", "TRUCK", "m2", Decimal("2"), False),
                                     ("s2", "SHOVEL", "m1", Decimal("1"), True)], eq),
              spark.createDataFrame([("B2", 9, "Q"), ("B1", 2, "Y")], loc),
              spark.createDataFrame([(d1, 2024, 1, 1, "January", 1, 0, "DIA")], tim))
    counts = wh.load_dimensions(*second)
    assert counts == {"dim_equipment": 1, "dim_location": 1, "dim_time": 0}
    eqs = {r.equipment_id: r.equipment_type for r in wh.table("dim_equipment").collect()}
    assert eqs == {"s1": "SHOVEL", "s2": "SHOVEL"}
    locs = {r.bench_id: (r.location_id, r.zone) for r in wh.table("dim_location").collect()}
    assert locs == {"B2": (1, "Z"), "B1": (2, "Y")}


def test_orphan_assay_rejected_before_any_write(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    raw_s = sensor_raw(spark, SF_SMALL)
    plans.run_etl(raw_s, assay_raw(spark, SF_SMALL), wh, refresh=True)
    before = wh.row_count("fact_assay_results")
    orphan = spark.createDataFrame(
        [(999999999, 888888888, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), Decimal("1"), Decimal("2.0"))],
        "assay_id long, reading_id long, sample_date timestamp_ntz, result_date timestamp_ntz, "
        "assay_cu_grade decimal(6,4), turnaround_days decimal(4,1)")
    no_sensor = plans.sensor_fact(raw_s).limit(0)
    with pytest.raises(KeyCheckError, match="reading_id not in"):
        wh.load_facts(no_sensor, orphan)
    assert wh.row_count("fact_assay_results") == before


def test_duplicate_key_rejected(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    raw_s = sensor_raw(spark, SF_SMALL)
    plans.run_etl(raw_s, assay_raw(spark, SF_SMALL), wh, refresh=True)
    with_dups = plans.transform_sensor(raw_s)   # still holds the late copies
    before = wh.row_count("fact_sensor_readings")
    with pytest.raises(KeyCheckError, match="duplicate or NULL keys"):
        wh.load_facts(with_dups, assay_raw(spark, SF_SMALL).limit(0).withColumn(
            "turnaround_days", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None)
            .cast("decimal(4,1)")), mode="overwrite")
    # a rejected overwrite leaves the stored table as it was
    assert wh.row_count("fact_sensor_readings") == before


def test_catalog_tables_with_comments(spark, tmp_root):
    wh = Warehouse(spark, tmp_root, database="grade_wh")
    plans.run_etl(sensor_raw(spark, SF_SMALL), assay_raw(spark, SF_SMALL), wh, refresh=True)
    assert spark.table("grade_wh.fact_sensor_readings").count() == wh.row_count("fact_sensor_readings")
    info = {r.col_name: r.data_type for r in
            spark.sql("DESCRIBE TABLE EXTENDED grade_wh.fact_assay_results").collect()}
    assert "Lab assays" in info.get("Comment", "")
    # month partitions prune: one month read, fewer rows
    one = spark.table("grade_wh.fact_sensor_readings").where("reading_month = DATE'2024-01-01'")
    assert 0 < one.count() < wh.row_count("fact_sensor_readings")


def test_bucketed_facts_join_without_shuffle(spark, tmp_root):
    from tests.test_plans import no_broadcast, plan_of
    raw_s, raw_a = sensor_raw(spark, SF_SMALL), assay_raw(spark, SF_SMALL)
    plain = Warehouse(spark, tmp_root + "/plain")
    plans.run_etl(raw_s, raw_a, plain, refresh=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_wh")
    wh = Warehouse(spark, tmp_root + "/bucketed", buckets=4, database="bucket_wh")
    plans.run_etl(raw_s, raw_a, wh, refresh=True)
    with no_broadcast(spark):
        recon = plans.reconciliation(wh.table("fact_sensor_readings"), wh.table("fact_assay_results"))
        plan = plan_of(recon)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning(reading_id" not in plan
    expected = plans.reconciliation(plain.table("fact_sensor_readings"), plain.table("fact_assay_results"))
    assert recon.exceptAll(expected).count() == 0 and expected.exceptAll(recon).count() == 0
    # a session without the catalog entries finds the bucketed facts again
    spark.sql("DROP DATABASE bucket_wh CASCADE")
    wh = Warehouse(spark, tmp_root + "/bucketed", buckets=4, database="bucket_wh")
    again = plans.reconciliation(wh.table("fact_sensor_readings"), wh.table("fact_assay_results"))
    assert again.exceptAll(expected).count() == 0 and again.count() == expected.count()
    with no_broadcast(spark):
        assert "Exchange hashpartitioning(reading_id" not in plan_of(again)
    # the append check against stored keys shuffles only the incoming side
    with no_broadcast(spark):
        incoming = plans.sensor_fact(raw_s).select("reading_id")
        clash = incoming.join(wh.table("fact_sensor_readings").select("reading_id"),
                              ["reading_id"], "left_semi")
        clash_plan = plan_of(clash)
    assert "Bucketed: true" in clash_plan
    assert clash_plan.count("Exchange hashpartitioning(reading_id") == 1
    # checked append still rejects stored keys on the bucketed tables
    with pytest.raises(KeyCheckError):
        plans.run_etl(raw_s, raw_a, wh, refresh=False)


def test_checked_append_publishes_into_month_folders(spark, tmp_root):
    import os
    from pyspark.sql import functions as F
    wh = Warehouse(spark, tmp_root)
    raw_s, raw_a = sensor_raw(spark, SF_SMALL), assay_raw(spark, SF_SMALL)
    sensor, assay = plans.sensor_fact(raw_s), plans.assay_fact(raw_a)
    early = F.col("reading_id") % 2 == 0          # two batches of readings, same months
    plans.run_etl(raw_s.where(early), raw_a.where(early), wh, refresh=True)
    first = wh.row_count("fact_sensor_readings")
    counts = wh.load_facts(sensor.where(~early), assay.where(~early), mode="append")
    assert counts["fact_sensor_readings"] == sensor.where(~early).count()
    assert wh.row_count("fact_sensor_readings") == first + counts["fact_sensor_readings"]
    stored = wh.table("fact_sensor_readings").drop("loaded_at", "reading_month")
    # first batch: transformed with the statistics of its own input; then the append
    expected = plans.sensor_fact(raw_s.where(early)).unionByName(sensor.where(~early))
    assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0
    assert wh.row_count("fact_assay_results") == assay.count()
    # the rows were inserted as month partitions of a second load
    folder = os.path.join(tmp_root, "fact_sensor_readings")
    loads = sorted(d for d in os.listdir(folder) if d.startswith("load_id="))
    assert [d.split("=")[1] for d in loads] == wh.live_loads("fact_sensor_readings") and len(loads) == 2
    assert all(any(m.startswith("reading_month=") for m in os.listdir(os.path.join(folder, d))) for d in loads)


def _sensor(spark, rows):
    return spark.createDataFrame(rows, schemas.SENSOR_RAW)


def _reading(i, equipment="E1", bench="BENCH-100", tonnage="100"):
    from decimal import Decimal
    return (i, i, dt.datetime(2025, 1, 1), equipment, bench, Decimal("1.0"), Decimal("1.0"),
            Decimal("0.5"), Decimal(tonnage))


def _assays(spark, rows=()):
    return spark.createDataFrame(list(rows), schemas.ASSAY_RAW)


def test_null_members_load_and_long_ids_do_not(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    plans.run_etl(_sensor(spark, [_reading(1), _reading(2, None, None)]), _assays(spark), wh)
    assert wh.row_count("fact_sensor_readings") == 2
    assert [r.equipment_id for r in wh.table("dim_equipment").collect()] == ["E1"]
    assert wh.row_count("dim_location") == 1
    with pytest.raises(KeyCheckError, match="longer than 20"):
        plans.run_etl(_sensor(spark, [_reading(1, "E" * 21)]), _assays(spark), wh)


def test_failed_refresh_changes_nothing_and_views_follow(spark, tmp_root):
    from decimal import Decimal
    wh = Warehouse(spark, tmp_root)
    plans.run_etl(_sensor(spark, [_reading(1)]), _assays(spark), wh)
    quality = wh.catalog_name("v_data_quality_report")
    orphan = (1, 99, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 3), Decimal("0.5"))
    with pytest.raises(KeyCheckError, match="reading_id not in"):
        plans.run_etl(_sensor(spark, [_reading(1, "eNEW")]), _assays(spark, [orphan]), wh)
    assert [r.equipment_id for r in wh.table("dim_equipment").collect()] == ["E1"]
    assert spark.table(quality).first().equipment_id == "E1"
    plans.run_etl(_sensor(spark, [_reading(1, "E2")]), _assays(spark), wh)
    assert spark.table(quality).first().equipment_id == "E2"


def test_absent_flag_columns_take_defaults(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    sensor = plans.sensor_fact(_sensor(spark, [_reading(1)]))
    dims = plans.build_dim_equipment(sensor).drop("active")
    from orebridge.plans.dims import build_dim_location, build_dim_time
    wh.load_dimensions(dims, build_dim_location(sensor), build_dim_time(sensor, _assays(spark)), mode="overwrite")
    wh.load_facts(sensor.drop("is_outlier", "is_duplicate", "qc_passed"), plans.assay_fact(_assays(spark)), mode="overwrite")
    row = wh.table("fact_sensor_readings").first()
    assert (row.is_outlier, row.is_duplicate, row.qc_passed) == (False, False, None)
    assert wh.table("dim_equipment").first().active is True


def test_report_prints_every_row(spark, capsys):
    df = spark.range(60).selectExpr("concat('line ', id) AS line")
    plans.show_report({"lines": df})
    assert capsys.readouterr().out.count("line ") == 60


class Crash(RuntimeError):
    pass


def _all_rows(wh):
    return {n: sorted(map(repr, wh.table(n).collect())) for n in schemas.TABLES}


@pytest.mark.parametrize("after_inserts", [1, 4, 5])
@pytest.mark.parametrize("refresh", [True, False])
def test_crash_during_a_load_leaves_all_five_tables(spark, tmp_root, monkeypatch, after_inserts, refresh):
    """The driver dies after some of the five inserts, or after all of them and before the commit."""
    wh = Warehouse(spark, tmp_root)
    plans.run_etl(_sensor(spark, [_reading(1), _reading(2, "E2")]), _assays(spark), wh)
    before, loads = _all_rows(wh), wh.live_loads("dim_time")
    done, insert = [], Warehouse._insert

    def dying(self, name, df, load, *more):
        if len(done) >= after_inserts:
            raise Crash(name)
        done.append(name)
        return insert(self, name, df, load, *more)

    def no_commit(self, *args):
        raise Crash("commit")
    monkeypatch.setattr(Warehouse, "_insert", dying)
    monkeypatch.setattr(Warehouse, "commit_load", no_commit)
    monkeypatch.setattr(Warehouse, "drop_load", lambda self, load: None)      # nobody left to clean up
    with pytest.raises(Crash):
        plans.run_etl(_sensor(spark, [_reading(7, "E7", "BENCH-7")]), _assays(spark), wh, refresh=refresh)
    monkeypatch.undo()
    # a session that knows nothing of it reads the old tables, by frame and by name
    spark.sql(f"DROP DATABASE {wh.database} CASCADE")
    wh = Warehouse(spark, tmp_root)
    assert _all_rows(wh) == before and wh.live_loads("dim_time") == loads
    assert spark.table(wh.catalog_name("fact_sensor_readings")).count() == 2
    # what the crashed load left can be dropped, and the next load works
    dropped = {load for found in wh.vacuum().values() for load in found}
    assert len(dropped) <= 1 and _all_rows(wh) == before
    plans.run_etl(_sensor(spark, [_reading(7, "E7", "BENCH-7")]), _assays(spark), wh, refresh=refresh)
    assert wh.row_count("fact_sensor_readings") == (1 if refresh else 3)


def test_vacuum_drops_replaced_loads_only(spark, tmp_root):
    import os
    wh = Warehouse(spark, tmp_root)
    for n in (1, 2, 3):
        plans.run_etl(_sensor(spark, [_reading(n)]), _assays(spark), wh, refresh=n != 3)
    old = wh.vacuum()
    assert len(old["fact_sensor_readings"]) == 1 and all(len(loads) <= 1 for loads in old.values())
    assert sorted(r.reading_id for r in wh.table("fact_sensor_readings").collect()) == [2, 3]
    stored = [d for d in os.listdir(f"{tmp_root}/fact_sensor_readings") if d.startswith("load_id=")]
    assert len(stored) == 2 and wh.vacuum() == {n: [] for n in schemas.TABLES}


def test_other_sessions_read_the_views_after_each_load(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    other = spark.newSession()
    raw_s, raw_a = sensor_raw(spark, SF_SMALL), assay_raw(spark, SF_SMALL)
    plans.run_etl(_sensor(spark, [_reading(1)]), _assays(spark), wh)
    names = [wh.catalog_name(v) for v in ("v_sensor_assay_reconciliation", "v_equipment_kpis",
                                          "v_monthly_grade_trend", "v_data_quality_report")]
    assert [other.table(n).count() for n in names] == [0, 0, 1, 1]
    plans.run_etl(raw_s, raw_a, wh)
    sensor, assay = plans.sensor_fact(raw_s), plans.assay_fact(raw_a)
    recon = plans.reconciliation(sensor, assay)
    want = [recon, plans.equipment_kpis(recon), plans.monthly_grade_trend(sensor, assay),
            plans.data_quality_report(sensor)]
    for name, df in zip(names, want):
        assert sorted(map(repr, other.table(name).collect())) == sorted(map(repr, df.collect()))


def test_partition_of_other_loads_is_not_read(spark, tmp_root):
    from tests.test_plans import plan_of
    wh = Warehouse(spark, tmp_root)
    for n in (1, 2):
        plans.run_etl(_sensor(spark, [_reading(n)]), _assays(spark), wh)
    by_name = spark.table(wh.catalog_name("fact_sensor_readings"))
    assert by_name.count() == 1
    assert "PartitionFilters" in plan_of(by_name) and "array_contains" in plan_of(by_name)
    files = wh.table("fact_sensor_readings").inputFiles()
    assert files and all(wh.live_loads("fact_sensor_readings")[0] in f for f in files)


def test_time_lookup_in_another_zone(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    raw = sensor_raw(spark, SF_SMALL)
    plans.run_etl(raw, assay_raw(spark, SF_SMALL), wh)
    start, end = dt.datetime(2024, 1, 20, 6, 30), dt.datetime(2024, 2, 2)
    want = sorted(r.reading_id for r in wh.table("fact_sensor_readings").collect() if start <= r.timestamp < end)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Santiago", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = sorted(r.reading_id for r in wh.rows_between("fact_sensor_readings", start, end).collect())
            assert got == want and got
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
