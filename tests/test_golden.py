"""Golden values at sf0.01 (FIXTURES.md §3), independent of the DuckDB twins."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orebridge import catalog, plans
from orebridge.sources import sensor_raw
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def facts(spark):
    sensor, assay = catalog.facts(spark, SF_CHECK)
    return sensor.cache(), assay.cache()


def test_counters_and_bounds(spark):
    c = plans.qc_counters(sensor_raw(spark, SF_CHECK)).first()
    assert (c.total_rows, c.duplicates, c.null_tonnage, c.outliers) == (10031, 31, 93, 182)
    b = plans.outlier_bounds(sensor_raw(spark, SF_CHECK)).first()
    assert b.lower_limit == 0.0 and round(b.upper_limit, 8) == 1.96791978


def test_kpis(facts):
    kpis = {r.equipment_id: r for r in plans.equipment_kpis(plans.reconciliation(*facts)).collect()}
    want = {  # paired, mae, rmse, rel %, bias, bands, tonnage
        "click": (137, "0.1247", 0.1464, "39.48", "-0.0075", (41, 26, 55, 15), 7249),
        "error": (158, "0.1503", 0.1940, "79.14", "0.1364", (60, 18, 36, 44), 7738),
        "purchase": (154, "0.1225", 0.1445, "8.38", "-0.0119", (44, 38, 53, 19), 7615),
        "signup": (181, "0.1193", 0.1451, "48.05", "0.0049", (65, 35, 52, 29), 9550),
        "view": (156, "0.1237", 0.1478, "54.44", "-0.0090", (48, 33, 52, 23), 7284),
    }
    for eq, (n, mae, rmse, rel, bias, bands, tons) in want.items():
        k = kpis[eq]
        assert (k.total_paired_readings, k.mae, k.rmse, k.mean_relative_error_pct, k.bias) == (
            n, Decimal(mae), rmse, Decimal(rel), Decimal(bias))
        assert (k.cat_excelente, k.cat_aceptable, k.cat_revisar, k.cat_critico) == bands
        assert k.total_tonnage == tons
    status = {r.equipment_id: r.status for r in
              plans.calibration_report(plans.equipment_kpis(plans.reconciliation(*facts))).collect()}
    assert [e for e, s in status.items() if s != "OK"] == ["error"]


def test_quality_and_summary(facts):
    sensor, assay = facts
    q = {r.equipment_id: (r.total_readings, r.outliers, r.failed_qc, r.qc_pass_rate_pct)
         for r in plans.data_quality_report(sensor).collect()}
    assert q["click"] == (2006, 37, 37, Decimal("98.16"))
    assert q["view"] == (1982, 25, 25, Decimal("98.74"))
    benches = [(r.bench_id, r.lecturas_outliers) for r in plans.outliers_by_bench(sensor).collect()]
    assert benches == [("BENCH-100", 54), ("BENCH-105", 44), ("BENCH-110", 42), ("BENCH-115", 42)]
    s = plans.run_summary(sensor, assay, sla_days=4).first()
    assert (s.readings, s.assays, s.assay_coverage_pct, s.mean_turnaround_days) == (
        10000, 800, Decimal("8.0"), Decimal("3.5"))


def test_monthly_first_month(facts):
    rows = plans.monthly_grade_trend(*facts).where(F.month("month") == 1).collect()
    got = [(r.bench_id, r.total_loads, r.avg_sensor_grade, r.avg_assay_grade, r.total_tonnage,
            r.estimated_cu_tons) for r in rows]
    assert got == [
        ("BENCH-100", 648, Decimal("0.4879"), Decimal("0.5601"), 33477, Decimal("163.32")),
        ("BENCH-105", 711, Decimal("0.4588"), Decimal("0.4391"), 34571, Decimal("158.62")),
        ("BENCH-110", 672, Decimal("0.4725"), Decimal("0.3615"), 33321, Decimal("157.44")),
        ("BENCH-115", 674, Decimal("0.4397"), Decimal("0.4186"), 35263, Decimal("155.06")),
    ]
    assert plans.monthly_grade_trend(*facts).count() == 12


def test_reconciliation_bands_and_dates(spark, facts):
    recon = plans.reconciliation(*facts)
    bands = {r.accuracy_category: r["count"] for r in recon.groupBy("accuracy_category").count().collect()}
    assert bands == {"EXCELENTE": 258, "ACEPTABLE": 150, "REVISAR": 248, "CRITICO": 130}
    assert recon.where(F.col("relative_error_pct").isNull()).count() == 122
    dim = plans.build_dim_time(sensor_raw(spark, SF_CHECK), catalog.assay_raw(spark, SF_CHECK))
    assert dim.count() == 90
