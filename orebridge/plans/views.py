"""The four analytic views (I6-I9), over the two fact tables, as SQL text.

Each view is written once, with the relations it reads as parameters: `reconciliation(df, df)`
and the like run it over DataFrames, `view_ddl` turns it into a catalog view over catalog
tables. All measures stay decimal until their ROUND, as NUMERIC does in the reference.
Results are small (one row per equipment or per month and bench); the final ORDER BY sorts
only those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from orebridge.functions.grades import ACCURACY_BANDS, ACCURACY_OTHERWISE
from orebridge.operators import semi_reduce

# Output columns, band labels and names of the views are fixed values: required output.
RECONCILIATION_COLUMNS = [
    "reading_id", "timestamp", "equipment_id", "bench_id", "sensor_cu_grade", "tonnage",
    "assay_cu_grade", "turnaround_days", "grade_difference", "relative_error_pct",
    "accuracy_category", "qc_passed",
]

VIEW_NAMES = {
    "reconciliation": "v_sensor_assay_reconciliation",
    "equipment_kpis": "v_equipment_kpis",
    "monthly_grade_trend": "v_monthly_grade_trend",
    "data_quality_report": "v_data_quality_report",
}


def mean(x: str) -> str:
    """AVG over non-NULL values as one decimal quotient (`avg` would round twice)."""
    return f"sum({x}) / nullif(count({x}), 0)"


_BANDS = " ".join(f"WHEN abs(s.sensor_cu_grade - a.assay_cu_grade) <= {limit}BD THEN '{label}'"
                  for limit, label in ACCURACY_BANDS)

# Each QC-passed reading with each of its assays; a NULL qc_passed is excluded.
RECONCILIATION = f"""
SELECT s.reading_id, s.timestamp, s.equipment_id, s.bench_id, s.sensor_cu_grade, s.tonnage,
       a.assay_cu_grade, a.turnaround_days,
       round(s.sensor_cu_grade - a.assay_cu_grade, 4) AS grade_difference,
       round((s.sensor_cu_grade - a.assay_cu_grade) / nullif(a.assay_cu_grade, 0BD) * 100, 2) AS relative_error_pct,
       CASE {_BANDS} ELSE '{ACCURACY_OTHERWISE}' END AS accuracy_category,
       s.qc_passed
FROM {{sensor}} AS s JOIN {{assay}} AS a ON s.reading_id = a.reading_id
WHERE s.qc_passed"""

_LABELS = [label for _, label in ACCURACY_BANDS] + [ACCURACY_OTHERWISE]
_CATEGORIES = ", ".join(f"count_if(accuracy_category = '{label}') AS {name}" for label, name in zip(
    _LABELS, ["cat_excelente", "cat_aceptable", "cat_revisar", "cat_critico"]))

# Accuracy per equipment. Tonnage is carried by the reconciliation rows, so the reference's
# self-join back to the sensor fact (same key, same row) is dropped.
EQUIPMENT_KPIS = f"""
SELECT equipment_id, count(*) AS total_paired_readings,
       round({mean('abs(grade_difference)')}, 4) AS mae,
       round(sqrt(CAST({mean('grade_difference * grade_difference')} AS DOUBLE)), 4) AS rmse,
       round({mean('relative_error_pct')}, 2) AS mean_relative_error_pct,
       round({mean('grade_difference')}, 4) AS bias,
       {_CATEGORIES},
       round(sum(tonnage), 0) AS total_tonnage
FROM {{recon}} GROUP BY equipment_id ORDER BY mae ASC NULLS LAST"""

# Grade and tonnage per month and bench. A reading with several assays counts once per assay
# (the reference's left join fans out), which is the sum over all readings, without a join,
# plus for each reading with c assays its assays and c - 1 more of itself. Only the second
# part joins, and only readings with an assay (`paired`).
MONTHLY_GRADE_TREND = """
WITH assays AS (
  SELECT reading_id, count(*) AS c, sum(assay_cu_grade) AS sum_a, count(assay_cu_grade) AS n_a
  FROM {assay} WHERE reading_id IS NOT NULL GROUP BY reading_id),
parts AS (
  SELECT trunc(to_date(timestamp), 'month') AS month, bench_id, count(*) AS loads,
         sum(sensor_cu_grade) AS sum_g, count(sensor_cu_grade) AS n_g, sum(tonnage) AS sum_t,
         CAST(NULL AS DECIMAL(26,4)) AS sum_a, 0L AS n_a
  FROM {sensor} WHERE qc_passed GROUP BY 1, 2
  UNION ALL
  SELECT trunc(to_date(s.timestamp), 'month'), s.bench_id, sum(c - 1),
         sum(s.sensor_cu_grade * CAST(c - 1 AS DECIMAL(18,0))), sum(if(s.sensor_cu_grade IS NULL, 0, c - 1)),
         sum(s.tonnage * CAST(c - 1 AS DECIMAL(18,0))), sum(a.sum_a), sum(a.n_a)
  FROM {paired} AS s JOIN assays AS a ON s.reading_id = a.reading_id
  WHERE s.qc_passed GROUP BY 1, 2),
totals AS (
  SELECT month, bench_id, sum(loads) AS loads, CAST(sum(sum_g) AS DECIMAL(16,4)) AS g, sum(n_g) AS n_g,
         CAST(sum(sum_t) AS DECIMAL(18,2)) AS t, CAST(sum(sum_a) AS DECIMAL(16,4)) AS a, sum(n_a) AS n_a
  FROM parts GROUP BY month, bench_id)
SELECT CAST(month AS TIMESTAMP_NTZ) AS month, bench_id, loads AS total_loads,
       round(g / nullif(n_g, 0), 4) AS avg_sensor_grade,
       round(a / nullif(n_a, 0), 4) AS avg_assay_grade,
       round(t, 0) AS total_tonnage,
       round(t * g / nullif(n_g * 100, 0), 2) AS estimated_cu_tons
FROM totals ORDER BY month ASC NULLS LAST, bench_id ASC NULLS LAST"""

# Defect counts and QC pass rate per equipment. A NULL flag counts nowhere.
DATA_QUALITY_REPORT = """
SELECT equipment_id, count(*) AS total_readings,
       count_if(is_duplicate) AS duplicates, count_if(is_outlier) AS outliers,
       count_if(tonnage IS NULL) AS null_tonnage, count_if(NOT qc_passed) AS failed_qc,
       round(100.0BD * count_if(qc_passed) / count(*), 2) AS qc_pass_rate_pct
FROM {sensor} GROUP BY equipment_id ORDER BY qc_pass_rate_pct ASC NULLS LAST"""


def view_ddl(prefix: str) -> dict[str, str]:
    """CREATE OR REPLACE VIEW statements, in order, for the facts and views named `prefix`.name."""
    facts = {"sensor": f"{prefix}.fact_sensor_readings", "assay": f"{prefix}.fact_assay_results",
             "paired": f"{prefix}.fact_sensor_readings", "recon": f"{prefix}.{VIEW_NAMES['reconciliation']}"}
    texts = {"reconciliation": RECONCILIATION, "equipment_kpis": EQUIPMENT_KPIS,
             "monthly_grade_trend": MONTHLY_GRADE_TREND, "data_quality_report": DATA_QUALITY_REPORT}
    return {key: f"CREATE OR REPLACE VIEW {prefix}.{VIEW_NAMES[key]} AS {text.format(**facts)}"
            for key, text in texts.items()}


def reconciliation(sensor: DataFrame, assay: DataFrame) -> DataFrame:
    """Each QC-passed reading with each of its assays."""
    return sensor.sparkSession.sql(RECONCILIATION, sensor=sensor, assay=assay)


def equipment_kpis(recon: DataFrame) -> DataFrame:
    """Accuracy per equipment."""
    return recon.sparkSession.sql(EQUIPMENT_KPIS, recon=recon)


def monthly_grade_trend(sensor: DataFrame, assay: DataFrame, paired: DataFrame | None = None) -> DataFrame:
    """Grade and tonnage per month and bench (I8). `paired`: the readings of `sensor` that may
    have an assay; found by a reduced semi-join where not given."""
    if paired is None:
        paired = semi_reduce(sensor, assay, "reading_id")
    return sensor.sparkSession.sql(MONTHLY_GRADE_TREND, sensor=sensor, assay=assay, paired=paired)


def data_quality_report(sensor: DataFrame) -> DataFrame:
    """Defect counts and QC pass rate per equipment."""
    return sensor.sparkSession.sql(DATA_QUALITY_REPORT, sensor=sensor)
