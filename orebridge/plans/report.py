"""The daily quality report (I10) and run summaries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from orebridge.functions import calibration_status, fixed, round_half_up
from orebridge.plans.views import equipment_kpis, reconciliation
from orebridge.session import reliable_checkpoint

# Parameter: an assay result later than this many days violates the lab SLA.
DEFAULT_SLA_DAYS = 5


def calibration_report(kpis: DataFrame) -> DataFrame:
    """Check 2: calibration status per equipment from its bias."""
    return kpis.select("equipment_id", "bias", "mae",
                       calibration_status("bias").alias("status"))


# The printed sentences below are fixed values: required output.
def calibration_messages(kpis: DataFrame) -> DataFrame:
    """Check 2 as text lines, one per equipment (H17, H20), built on the executors."""
    return kpis.select(F.format_string(
        "Equipo %s: Bias = %s | MAE = %s -> %s", F.col("equipment_id"),
        fixed("bias", 4), fixed("mae", 4), calibration_status("bias")).alias("line"))


def turnaround_messages(summary: DataFrame) -> DataFrame:
    """Check 3 as two text lines, 2 decimals."""
    return summary.select(F.explode(F.array(
        F.concat(F.lit("Turnaround promedio : "), fixed("avg_t", 2), F.lit(" días")),
        F.concat(F.lit("Turnaround máximo   : "), fixed("max_t", 2), F.lit(" días")),
    )).alias("line"))


def turnaround_summary(assay: DataFrame) -> DataFrame:
    """Check 3: mean and max turnaround; 0 when there are no assays."""
    t = F.col("turnaround_days")
    return assay.agg(
        F.coalesce(F.sum(t) / F.nullif(F.count(t), F.lit(0)), F.lit(Decimal(0))).alias("avg_t"),
        F.coalesce(F.max(t), F.lit(Decimal(0)).cast(assay.schema["turnaround_days"].dataType))
        .alias("max_t"),
    )


def outliers_by_bench(sensor: DataFrame) -> DataFrame:
    """Check 4: outlier readings per bench, most first (D16); bench breaks ties."""
    return (sensor.where(F.col("is_outlier")).groupBy("bench_id")
            .agg(F.count(F.lit(1)).alias("lecturas_outliers"))
            .orderBy(F.col("lecturas_outliers").desc_nulls_first(),
                     F.col("bench_id").asc_nulls_last()))


def run_summary(sensor: DataFrame, assay: DataFrame,
                sla_days: int = DEFAULT_SLA_DAYS) -> DataFrame:
    """One row: readings, assays, QC pass rate %, assay coverage %, mean turnaround and
    SLA violations (turnaround > `sla_days`). The assay figures arrive as one
    scalar subquery, so the two facts are never joined."""
    t = F.col("turnaround_days")
    assay_stats = assay.select(F.struct(
        F.count(F.lit(1)).alias("assays"),
        (F.sum(t) / F.nullif(F.count(t), F.lit(0))).alias("mean_t"),
        F.count_if(t > F.lit(sla_days)).alias("sla_violations"),
    )).scalar()
    readings = F.count(F.lit(1))
    hundred = F.lit(Decimal("100.0"))
    return sensor.agg(
        readings.alias("readings"),
        assay_stats.getField("assays").alias("assays"),
        round_half_up(hundred * F.count_if(F.col("qc_passed")) / F.nullif(readings, F.lit(0)), 2)
        .alias("qc_pass_rate_pct"),
        round_half_up(hundred * assay_stats.getField("assays") / F.nullif(readings, F.lit(0)), 1)
        .alias("assay_coverage_pct"),
        round_half_up(assay_stats.getField("mean_t"), 1).alias("mean_turnaround_days"),
        assay_stats.getField("sla_violations").alias("sla_violations"),
    )


def quality_report(sensor: DataFrame, assay: DataFrame, kpis: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four checks of the daily report, as DataFrames (nothing is collected). The few KPI
    rows (one per equipment) are materialised, as three of the checks read them."""
    kpis = reliable_checkpoint(equipment_kpis(reconciliation(sensor, assay)) if kpis is None else kpis)
    turnaround = turnaround_summary(assay)
    return {
        "equipment_kpis": kpis,
        "calibration": calibration_report(kpis),
        "calibration_lines": calibration_messages(kpis),
        "turnaround": turnaround,
        "turnaround_lines": turnaround_messages(turnaround),
        "outliers_by_bench": outliers_by_bench(sensor),
    }


def warehouse_report(warehouse) -> dict[str, DataFrame]:
    """The report over a warehouse: the KPIs come from its catalog view."""
    return quality_report(warehouse.table("fact_sensor_readings"), warehouse.table("fact_assay_results"),
                          kpis=warehouse.register_views()["equipment_kpis"])


def show_report(report: dict[str, DataFrame]) -> None:
    """Print every row of each check (A20), streamed partition by partition."""
    for name, df in report.items():
        print(f"== {name}")
        print(" | ".join(df.columns))
        for row in df.toLocalIterator():
            print(" | ".join("" if v is None else str(v) for v in row))
