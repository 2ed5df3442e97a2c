"""Composite jobs built from the generic operators."""

from orebridge.plans.assay import assay_fact, mean_turnaround, transform_assay
from orebridge.plans.dims import (build_dim_equipment, build_dim_location, build_dim_time,
                                  with_location_ids, with_time_ids)
from orebridge.plans.report import (calibration_messages, calibration_report,
                                    outliers_by_bench, quality_report, run_summary,
                                    show_report, turnaround_messages, turnaround_summary,
                                    warehouse_report)
from orebridge.plans.sensor import (RawStatistics, first_sensor_fact, outlier_bounds, paired_sensor_fact,
                                    qc_counters, raw_statistics, sensor_fact, tonnage_medians, transform_sensor)
from orebridge.plans.etl import extract, run_etl
from orebridge.plans.views import (data_quality_report, equipment_kpis,
                                   monthly_grade_trend, reconciliation)

__all__ = [
    "RawStatistics", "assay_fact", "build_dim_equipment", "build_dim_location", "build_dim_time",
    "calibration_messages", "calibration_report", "data_quality_report",
    "equipment_kpis", "extract", "first_sensor_fact", "mean_turnaround", "monthly_grade_trend",
    "outlier_bounds", "outliers_by_bench", "paired_sensor_fact", "qc_counters", "quality_report",
    "raw_statistics", "reconciliation", "run_etl", "run_summary", "sensor_fact", "show_report",
    "tonnage_medians", "transform_assay", "transform_sensor", "turnaround_messages",
    "turnaround_summary", "warehouse_report", "with_location_ids", "with_time_ids",
]
