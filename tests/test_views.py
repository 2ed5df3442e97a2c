import datetime as dt
from decimal import Decimal

from orebridge import plans

SENSOR = ("reading_id long, timestamp timestamp_ntz, equipment_id string, bench_id string, "
          "x_coord decimal(10,2), y_coord decimal(10,2), sensor_cu_grade decimal(6,4), "
          "tonnage decimal(8,2), is_outlier boolean, is_duplicate boolean, qc_passed boolean")
ASSAY = ("assay_id long, reading_id long, sample_date timestamp_ntz, result_date timestamp_ntz, "
         "assay_cu_grade decimal(6,4), turnaround_days decimal(4,1)")
T0 = dt.datetime(2024, 1, 5, 8, 0)


def _sensor(spark, rows):
    full = [(rid, T0, eq, "BENCH-100", Decimal("1"), Decimal("1"), Decimal(g),
             Decimal(t) if t is not None else None, False, False, qc) for rid, eq, g, t, qc in rows]
    return spark.createDataFrame(full, SENSOR)


def _assay(spark, rows):
    full = [(aid, rid, T0, T0 + dt.timedelta(days=2), Decimal(g), Decimal("2.0")) for aid, rid, g in rows]
    return spark.createDataFrame(full, ASSAY)


def test_two_assays_fan_out_in_monthly_view(spark):
    s = _sensor(spark, [(1, "a", "1.0", "10", True), (2, "a", "2.0", "20", True)])
    a = _assay(spark, [(1, 1, "1.1"), (2, 1, "0.9")])
    m = plans.monthly_grade_trend(s, a).first()
    assert m.total_loads == 3 and m.total_tonnage == Decimal("40")
    k = plans.equipment_kpis(plans.reconciliation(s, a)).first()
    assert k.total_paired_readings == 2 and k.total_tonnage == Decimal("20")


def test_assay_of_failed_or_null_qc_reading_is_dropped(spark):
    s = _sensor(spark, [(1, "a", "1.0", "10", False), (2, "a", "1.0", "10", None),
                        (3, "a", "1.0", "10", True)])
    a = _assay(spark, [(1, 1, "1.0"), (2, 2, "1.0"), (3, 3, "1.0")])
    assert [r.reading_id for r in plans.reconciliation(s, a).collect()] == [3]


def test_null_qc_counts_nowhere(spark):
    s = _sensor(spark, [(1, "a", "1.0", "10", None), (2, "a", "1.0", "10", True),
                        (3, "a", "1.0", None, False)])
    r = plans.data_quality_report(s).first()
    assert (r.total_readings, r.failed_qc, r.null_tonnage) == (3, 1, 1)
    assert r.qc_pass_rate_pct == Decimal("33.33")


def test_kpi_measures_exact(spark):
    s = _sensor(spark, [(1, "a", "1.0000", "10", True), (2, "a", "0.5000", "10", True)])
    a = _assay(spark, [(1, 1, "0.9000"), (2, 2, "0.6000")])
    k = plans.equipment_kpis(plans.reconciliation(s, a)).first()
    assert (k.mae, k.bias, k.rmse) == (Decimal("0.1000"), Decimal("0.0000"), 0.1)
    assert k.mean_relative_error_pct == Decimal("-2.78")   # (11.11 + -16.67) / 2


def test_empty_assays_turnaround_zero(spark):
    r = plans.turnaround_summary(spark.createDataFrame([], ASSAY)).first()
    assert r.avg_t == 0 and r.max_t == 0


def test_sensor_fact_equals_transform_without_duplicates(spark):
    from orebridge.sources import sensor_raw
    from tests.conftest import SF_SMALL
    raw = sensor_raw(spark, SF_SMALL)
    full = plans.transform_sensor(raw).where("NOT is_duplicate").drop("ingest_seq")
    fact = plans.sensor_fact(raw)
    assert full.select(*fact.columns).exceptAll(fact).count() == 0
    assert fact.exceptAll(full.select(*fact.columns)).count() == 0


def test_report_lines(spark):
    s = _sensor(spark, [(1, "a", "1.0000", "10", True)])
    a = _assay(spark, [(1, 1, "0.9000")])
    kpis = plans.equipment_kpis(plans.reconciliation(s, a))
    assert [r.line for r in plans.calibration_messages(kpis).collect()] == [
        "Equipo a: Bias = 0.1000 | MAE = 0.1000 -> REVISAR CALIBRACIÓN"]
    lines = [r.line for r in plans.turnaround_messages(plans.turnaround_summary(a)).collect()]
    assert lines == ["Turnaround promedio : 2.00 días", "Turnaround máximo   : 2.00 días"]
