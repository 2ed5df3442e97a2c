"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code, in plain SQL over the shared test tables.
DuckDB turns decimal AVG and `/` into DOUBLE, so every ROUND of a quotient is done
on scaled integers: `rhalf(n, d)` = n/d rounded half away from zero, d > 0.
Decimal outputs are cast to DOUBLE on both sides.
"""

from __future__ import annotations

# The two fixture inputs, as FIXTURES.md defines them.
SENSOR_BASE = """
SELECT event_id AS ingest_seq, event_id AS reading_id,
       ts + INTERVAL '1' DAY * CAST(event_id % 60 AS INT) AS "timestamp",
       event_type AS equipment_id,
       concat('BENCH-', CAST(100 + 5 * (user_id % 4) AS VARCHAR(10))) AS bench_id,
       CAST(1000 + user_id AS DECIMAL(10,2)) AS x_coord,
       CAST(5000 + user_id AS DECIMAL(10,2)) AS y_coord,
       CAST(CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(6,4)) AS DECIMAL(6,4)) AS sensor_cu_grade,
       CAST(nullif(CAST(regexp_extract(props, '[0-9]+', 0) AS INT), 0) AS DECIMAL(8,2)) AS tonnage
FROM events"""

SENSOR_RAW = SENSOR_BASE + """
UNION ALL
SELECT event_id + 1000000000, event_id,
       ts + INTERVAL '1' DAY * CAST(event_id % 60 AS INT),
       event_type,
       concat('BENCH-', CAST(100 + 5 * (user_id % 4) AS VARCHAR(10))),
       CAST(1000 + user_id AS DECIMAL(10,2)),
       CAST(5000 + user_id AS DECIMAL(10,2)),
       CAST(CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(6,4)) AS DECIMAL(6,4)),
       CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) + 1 AS DECIMAL(8,2))
FROM events WHERE event_id % 333 = 7"""

ASSAY_RAW = """
SELECT event_id AS assay_id, event_id AS reading_id,
       ts + INTERVAL '1' DAY * CAST(event_id % 60 AS INT) AS sample_date,
       ts + INTERVAL '1' DAY * CAST(event_id % 60 + 2 + event_id % 4 AS INT) AS result_date,
       CAST(CAST(greatest(0, CAST(round(value * 100) AS BIGINT) - 500 * (event_id % 11 - 5)
            - CASE WHEN event_type = 'error' THEN 2000 ELSE 0 END) AS DECIMAL(12,0))
            * CAST(0.0001 AS DECIMAL(6,4)) AS DECIMAL(6,4)) AS assay_cu_grade
FROM events WHERE event_id % 25 < 2"""


def rhalf(n: str, d: str) -> str:
    n = f"CAST(({n}) AS HUGEINT)"
    d = f"CAST(({d}) AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def scaled(expr: str, places: int) -> str:
    """A decimal with `places` decimals as an exact integer count of 10^-places."""
    return f"CAST(({expr}) * {10 ** places} AS HUGEINT)"


def ratio(n: str, d: str, places: int) -> str:
    """round(n / d, places) as DOUBLE, where n is already scaled by 10^places."""
    return f"(CAST({rhalf(n, d)} AS DOUBLE) / {10 ** places})"


RAW_COLS = ["ingest_seq", "reading_id", '"timestamp"', "equipment_id", "bench_id",
            "x_coord", "y_coord", "sensor_cu_grade", "tonnage"]
DECIMALS = {"x_coord", "y_coord", "sensor_cu_grade", "tonnage", "assay_cu_grade",
            "turnaround_days", "capacity_tons"}


def proj(cols, prefix: str = "") -> str:
    out = []
    for c in cols:
        bare = c.strip('"')
        ref = f"{prefix}{c}"
        out.append(f"CAST({ref} AS DOUBLE) AS {bare}" if bare in DECIMALS else f"{ref} AS {c}")
    return ", ".join(out)


SENSOR_FACT_COLS = ["reading_id", '"timestamp"', "equipment_id", "bench_id", "x_coord",
                    "y_coord", "sensor_cu_grade", "tonnage", "is_outlier", "is_duplicate",
                    "qc_passed"]
ASSAY_FACT_COLS = ["assay_id", "reading_id", "sample_date", "result_date", "assay_cu_grade",
                   "turnaround_days"]

TURNAROUND = ("CAST(CAST(" + rhalf("datediff('microsecond', sample_date, result_date) * 10",
                                   "86400000000")
              + " AS DECIMAL(18,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(4,1))")

# Shared CTE chain: inputs, medians, bounds, flags, both facts.
BASE = f"""
WITH sensor_raw AS ({SENSOR_RAW}
),
assay_raw AS ({ASSAY_RAW}
),
med_rank AS (
  SELECT equipment_id, tonnage,
         row_number() OVER (PARTITION BY equipment_id ORDER BY tonnage) AS rn,
         count(*) OVER (PARTITION BY equipment_id) AS n
  FROM sensor_raw WHERE equipment_id IS NOT NULL AND tonnage IS NOT NULL
),
med AS (
  SELECT equipment_id, min(tonnage) AS lo, max(tonnage) AS hi
  FROM med_rank WHERE rn IN ((n + 1) // 2, (n + 2) // 2) GROUP BY equipment_id
),
med_fill AS (
  SELECT equipment_id, lo, hi,
         CAST(CAST({rhalf(scaled('lo + hi', 2), '2')} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(8,2)) AS fill
  FROM med
),
bounds AS (
  SELECT avg(g) AS mean, stddev_samp(g) AS std,
         greatest(0, avg(g) - 3 * stddev_samp(g)) AS lower_limit,
         avg(g) + 3 * stddev_samp(g) AS upper_limit
  FROM (SELECT CAST(sensor_cu_grade AS DOUBLE) AS g FROM sensor_raw)
),
flagged AS (
  SELECT r.ingest_seq, r.reading_id, r."timestamp", r.equipment_id, r.bench_id,
         r.x_coord, r.y_coord, r.sensor_cu_grade,
         CASE WHEN r.equipment_id IS NULL THEN NULL ELSE coalesce(r.tonnage, m.fill) END AS tonnage,
         r.tonnage AS tonnage_raw,
         row_number() OVER (PARTITION BY r.reading_id ORDER BY r.ingest_seq) > 1 AS is_duplicate,
         coalesce(CAST(r.sensor_cu_grade AS DOUBLE) > (SELECT upper_limit FROM bounds)
                  OR CAST(r.sensor_cu_grade AS DOUBLE) < (SELECT lower_limit FROM bounds),
                  false) AS is_outlier
  FROM sensor_raw r LEFT JOIN med_fill m ON r.equipment_id = m.equipment_id
),
sensor_t AS (
  SELECT *, NOT is_duplicate AND NOT is_outlier AND tonnage IS NOT NULL AS qc_passed FROM flagged
),
fact_sensor AS (
  SELECT {", ".join(SENSOR_FACT_COLS)} FROM sensor_t WHERE NOT is_duplicate
),
fact_assay AS (
  SELECT assay_id, reading_id, sample_date, result_date, assay_cu_grade,
         {TURNAROUND} AS turnaround_days
  FROM assay_raw
),
recon AS (
  SELECT s.reading_id, s."timestamp", s.equipment_id, s.bench_id, s.sensor_cu_grade, s.tonnage,
         a.assay_cu_grade, a.turnaround_days, s.qc_passed,
         {scaled('s.sensor_cu_grade - a.assay_cu_grade', 4)} AS d,
         {rhalf(scaled('s.sensor_cu_grade - a.assay_cu_grade', 4) + ' * 10000',
                'NULLIF(' + scaled('a.assay_cu_grade', 4) + ', 0)')} AS r,
         CASE WHEN abs(s.sensor_cu_grade - a.assay_cu_grade) <= 0.05 THEN 'EXCELENTE'
              WHEN abs(s.sensor_cu_grade - a.assay_cu_grade) <= 0.10 THEN 'ACEPTABLE'
              WHEN abs(s.sensor_cu_grade - a.assay_cu_grade) <= 0.20 THEN 'REVISAR'
              ELSE 'CRITICO' END AS accuracy_category
  FROM fact_sensor s JOIN fact_assay a ON s.reading_id = a.reading_id
  WHERE s.qc_passed
),
kpis AS (
  SELECT equipment_id, count(*) AS total_paired_readings,
         {ratio('sum(abs(d))', 'count(d)', 4)} AS mae,
         round(sqrt(CAST(sum(d * d) AS DOUBLE) / (count(d) * 100000000.0)), 4) AS rmse,
         {ratio('sum(r)', 'NULLIF(count(r), 0)', 2)} AS mean_relative_error_pct,
         {ratio('sum(d)', 'count(d)', 4)} AS bias,
         count(*) FILTER (WHERE accuracy_category = 'EXCELENTE') AS cat_excelente,
         count(*) FILTER (WHERE accuracy_category = 'ACEPTABLE') AS cat_aceptable,
         count(*) FILTER (WHERE accuracy_category = 'REVISAR') AS cat_revisar,
         count(*) FILTER (WHERE accuracy_category = 'CRITICO') AS cat_critico,
         CAST(round(sum(tonnage), 0) AS DOUBLE) AS total_tonnage
  FROM recon GROUP BY equipment_id
)"""

DIM_TIME_COLS = """CAST(year(full_date) AS INTEGER) AS year,
       CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month,
       strftime(full_date, '%B') AS month_name,
       CAST(week(full_date) AS INTEGER) AS week,
       CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
       'DIA' AS shift"""

# The same chain with an assay for every reading, and with results that take some hours more.
EVERY = BASE.replace("FROM events WHERE event_id % 25 < 2", "FROM events")
HOURLY = EVERY.replace("CAST(event_id % 60 + 2 + event_id % 4 AS INT) AS result_date",
                       "CAST(event_id % 60 + 2 + event_id % 4 AS INT)\n"
                       "          + INTERVAL '1' HOUR * CAST(event_id % 24 AS INT) AS result_date")

# Output columns, band labels and limits below are fixed values of the compared results.
ORACLE: dict[str, str] = {
    "duplicate_flags": BASE + f"""
SELECT {proj(RAW_COLS)}, is_duplicate FROM (
  SELECT *, row_number() OVER (PARTITION BY reading_id ORDER BY ingest_seq) > 1 AS is_duplicate
  FROM sensor_raw)""",

    "dedup_keep_first": BASE + f"""
SELECT {proj(RAW_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY reading_id ORDER BY ingest_seq) AS rn FROM sensor_raw)
WHERE rn = 1""",

    "dedup_lineitem": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem)
WHERE rn = 1""",

    "lineitem_duplicate_flags": """
SELECT *, row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus, l_shipdate) > 1 AS is_duplicate
FROM lineitem""",

    "group_median": BASE + """
SELECT equipment_id, CAST(lo + hi AS DOUBLE) / 2 AS median FROM med""",

    "lineitem_price_median": """
SELECT l_returnflag, (min(l_extendedprice) + max(l_extendedprice)) / 2 AS median
FROM (SELECT l_returnflag, l_extendedprice,
             row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS rn,
             count(*) OVER (PARTITION BY l_returnflag) AS n
      FROM lineitem WHERE l_returnflag IS NOT NULL AND l_extendedprice IS NOT NULL)
WHERE rn IN ((n + 1) // 2, (n + 2) // 2)
GROUP BY l_returnflag""",

    "impute_group_median": BASE + f"""
SELECT {proj(RAW_COLS)} FROM flagged""",

    "outlier_bounds": BASE + """
SELECT round(mean, 8) AS mean, round(std, 8) AS std,
       round(lower_limit, 8) AS lower_limit, round(upper_limit, 8) AS upper_limit
FROM bounds""",

    "outlier_flags": BASE + f"""
SELECT {proj(RAW_COLS[:-1])}, CAST(tonnage_raw AS DOUBLE) AS tonnage, is_outlier FROM flagged""",

    "transform_sensor": BASE + f"""
SELECT {proj(RAW_COLS)}, is_duplicate, is_outlier, qc_passed FROM sensor_t""",

    "qc_counters": BASE + """
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE is_duplicate) AS duplicates,
       count(*) FILTER (WHERE tonnage_raw IS NULL) AS null_tonnage,
       count(*) FILTER (WHERE is_outlier) AS outliers,
       count(*) FILTER (WHERE qc_passed) AS qc_passed
FROM sensor_t""",

    "transform_assay": EVERY + """
SELECT assay_id, reading_id, sample_date, result_date, CAST(assay_cu_grade AS DOUBLE) AS assay_cu_grade,
       CAST(datediff('microsecond', sample_date, result_date) AS DOUBLE) / 86400000000.0 AS turnaround_days
FROM assay_raw""",

    "fact_sensor": BASE + f"""
SELECT {proj(SENSOR_FACT_COLS)} FROM fact_sensor""",

    "fact_assay": EVERY + f"""
SELECT {proj(ASSAY_FACT_COLS)} FROM fact_assay""",

    "dim_equipment": BASE + """
SELECT equipment_id, 'SHOVEL' AS equipment_type, 'CAT 7495' AS model,
       CAST(250.0 AS DOUBLE) AS capacity_tons, true AS active
FROM (SELECT DISTINCT equipment_id FROM sensor_raw)""",

    "dim_location": BASE + """
SELECT row_number() OVER (ORDER BY bench_id NULLS FIRST) AS location_id, bench_id,
       CAST(CASE bench_id WHEN 'BENCH-100' THEN 3100 WHEN 'BENCH-105' THEN 3095
                          WHEN 'BENCH-110' THEN 3090 ELSE 3000 END AS INTEGER) AS bench_elevation,
       CASE bench_id WHEN 'BENCH-100' THEN 'SULFIDE' WHEN 'BENCH-105' THEN 'SULFIDE'
                     WHEN 'BENCH-110' THEN 'OXIDE' ELSE 'UNKNOWN' END AS zone
FROM (SELECT DISTINCT bench_id FROM sensor_raw)""",

    "dim_time": EVERY + f""",
dates AS (
  SELECT CAST("timestamp" AS DATE) AS full_date FROM sensor_raw
  UNION SELECT CAST(sample_date AS DATE) FROM assay_raw
  UNION SELECT CAST(result_date AS DATE) FROM assay_raw
)
SELECT row_number() OVER (ORDER BY full_date) AS time_id, full_date,
       {DIM_TIME_COLS}
FROM dates WHERE full_date IS NOT NULL""",

    "dim_insert_new": EVERY + f""",
existing AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS full_date FROM sensor_raw),
incoming AS (
  SELECT CAST(sample_date AS DATE) AS full_date FROM assay_raw
  UNION SELECT CAST(result_date AS DATE) FROM assay_raw
)
SELECT (SELECT count(*) FROM existing) + row_number() OVER (ORDER BY full_date) AS time_id,
       full_date, {DIM_TIME_COLS}
FROM incoming
WHERE full_date IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.full_date = incoming.full_date)""",

    "fk_orphans": BASE + """
SELECT reading_id, count(*) AS n_rows FROM fact_assay a
WHERE reading_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM fact_sensor s WHERE s.qc_passed AND s.reading_id = a.reading_id)
GROUP BY reading_id""",

    "key_violations": BASE + """
SELECT reading_id, count(*) AS n_rows FROM sensor_raw
GROUP BY reading_id HAVING count(*) > 1 OR reading_id IS NULL""",

    "reconciliation": BASE + f"""
SELECT reading_id, "timestamp", equipment_id, bench_id,
       CAST(sensor_cu_grade AS DOUBLE) AS sensor_cu_grade, CAST(tonnage AS DOUBLE) AS tonnage,
       CAST(assay_cu_grade AS DOUBLE) AS assay_cu_grade,
       CAST(turnaround_days AS DOUBLE) AS turnaround_days,
       CAST(d AS DOUBLE) / 10000 AS grade_difference,
       CAST(r AS DOUBLE) / 100 AS relative_error_pct,
       accuracy_category, qc_passed
FROM recon""",

    "equipment_kpis": BASE + """
SELECT * FROM kpis""",

    "calibration_status": BASE + """
SELECT equipment_id, bias, mae,
       CASE WHEN abs(bias) <= 0.05 THEN 'OK' ELSE 'REVISAR CALIBRACIÓN' END AS status
FROM kpis""",

    "calibration_lines": BASE + """
SELECT printf('Equipo %s: Bias = %.4f | MAE = %.4f -> %s', equipment_id, bias, mae,
              CASE WHEN abs(bias) <= 0.05 THEN 'OK' ELSE 'REVISAR CALIBRACIÓN' END) AS line
FROM kpis""",

    "monthly_grade_trend": BASE + f""",
rows AS (
  SELECT s."timestamp", s.bench_id, s.tonnage, s.sensor_cu_grade, a.assay_cu_grade,
         {scaled('s.sensor_cu_grade', 4)} AS g, {scaled('a.assay_cu_grade', 4)} AS ag,
         {scaled('s.tonnage', 2)} AS t
  FROM fact_sensor s LEFT JOIN fact_assay a ON s.reading_id = a.reading_id
  WHERE s.qc_passed
)
SELECT CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month, bench_id,
       count(*) AS total_loads,
       {ratio('sum(g)', 'NULLIF(count(g), 0)', 4)} AS avg_sensor_grade,
       {ratio('sum(ag)', 'NULLIF(count(ag), 0)', 4)} AS avg_assay_grade,
       CAST(round(sum(tonnage), 0) AS DOUBLE) AS total_tonnage,
       {ratio('sum(t) * sum(g)', 'NULLIF(count(g), 0) * 1000000', 2)} AS estimated_cu_tons
FROM rows GROUP BY 1, 2""",

    "data_quality_report": BASE + f"""
SELECT equipment_id, count(*) AS total_readings,
       count(*) FILTER (WHERE is_duplicate) AS duplicates,
       count(*) FILTER (WHERE is_outlier) AS outliers,
       count(*) FILTER (WHERE tonnage IS NULL) AS null_tonnage,
       count(*) FILTER (WHERE NOT qc_passed) AS failed_qc,
       {ratio('count(*) FILTER (WHERE qc_passed) * 10000', 'count(*)', 2)} AS qc_pass_rate_pct
FROM fact_sensor GROUP BY equipment_id""",

    "mean_turnaround": HOURLY + """
SELECT round(CAST(sum(datediff('microsecond', sample_date, result_date)) AS DOUBLE) / count(*) / 86400000000.0, 6)
       AS mean_turnaround_days
FROM assay_raw""",

    "turnaround_lines": HOURLY + """,
t AS (
  SELECT CAST(sum(turnaround_days) AS DOUBLE) / count(*) AS avg_t, CAST(max(turnaround_days) AS DOUBLE) AS max_t
  FROM fact_assay)
SELECT printf('Turnaround promedio : %.2f días', avg_t) AS line FROM t
UNION ALL SELECT printf('Turnaround máximo   : %.2f días', max_t) FROM t""",

    "table_row_counts": BASE + """,
dates AS (
  SELECT CAST("timestamp" AS DATE) AS d FROM sensor_raw UNION SELECT CAST(sample_date AS DATE) FROM assay_raw
  UNION SELECT CAST(result_date AS DATE) FROM assay_raw),
n AS (
  SELECT 'dim_equipment' AS table_name, count(DISTINCT equipment_id) AS stored_rows FROM sensor_raw
  UNION ALL SELECT 'dim_location', count(DISTINCT bench_id) FROM sensor_raw
  UNION ALL SELECT 'dim_time', count(d) FROM dates
  UNION ALL SELECT 'fact_sensor_readings', count(*) FROM fact_sensor
  UNION ALL SELECT 'fact_assay_results', count(*) FROM fact_assay)
SELECT table_name, stored_rows, stored_rows AS observed_rows FROM n""",

    "csv_arrival_order": BASE + f"""
SELECT {proj(RAW_COLS[1:])} FROM (
  SELECT *, row_number() OVER (PARTITION BY reading_id ORDER BY ingest_seq) AS rn FROM sensor_raw)
WHERE rn = 1""",

    "turnaround_summary": EVERY + """
SELECT coalesce(CAST(sum(turnaround_days) AS DOUBLE) / NULLIF(count(turnaround_days), 0), 0) AS avg_t,
       coalesce(CAST(max(turnaround_days) AS DOUBLE), 0) AS max_t
FROM fact_assay""",

    "outliers_by_bench": BASE + """
SELECT bench_id, count(*) AS lecturas_outliers FROM fact_sensor WHERE is_outlier GROUP BY bench_id""",

    "run_summary": BASE + f""",
a AS (
  SELECT count(*) AS assays,
         {ratio(scaled('sum(turnaround_days)', 1), 'NULLIF(count(turnaround_days), 0)', 1)} AS mean_t,
         count(*) FILTER (WHERE turnaround_days > 4) AS sla_violations
  FROM fact_assay
)
SELECT count(*) AS readings, (SELECT assays FROM a) AS assays,
       {ratio('count(*) FILTER (WHERE qc_passed) * 10000', 'NULLIF(count(*), 0)', 2)} AS qc_pass_rate_pct,
       {ratio('(SELECT assays FROM a) * 1000', 'NULLIF(count(*), 0)', 1)} AS assay_coverage_pct,
       (SELECT mean_t FROM a) AS mean_turnaround_days,
       (SELECT sla_violations FROM a) AS sla_violations
FROM fact_sensor""",

    "inject_defects": BASE + f""",
base AS ({SENSOR_BASE}
),
modified AS (
  SELECT ingest_seq, reading_id, "timestamp", equipment_id, bench_id, x_coord, y_coord,
         CASE WHEN (reading_id + 2) % 200 < 1 THEN CAST(sensor_cu_grade * 10 AS DECIMAL(6,4))
              ELSE sensor_cu_grade END AS sensor_cu_grade,
         CASE WHEN (reading_id + 1) % 100 < 1 THEN NULL ELSE tonnage END AS tonnage
  FROM base
)
SELECT {proj(RAW_COLS)} FROM modified
UNION ALL
SELECT ingest_seq + 4611686018427387904 AS ingest_seq, {proj(RAW_COLS[1:])}
FROM modified WHERE (reading_id + 3) % 1000 < 3""",
}

_MONTHS = """CAST(date_trunc('month', "timestamp") AS TIMESTAMP)"""
_SENSOR_NOTE = ("Online sensor grade readings, one row per shovel load: every load, fast, less precise than the lab.")
_ASSAY_NOTE = ("Lab assays of samples taken from loads: about 8% of loads, precise, results 2-5 working days later. "
               "reading_id refers to fact_sensor_readings.")

ORACLE |= {
    "append_row_counts": BASE + """,
dates AS (
  SELECT CAST("timestamp" AS DATE) AS d FROM fact_sensor UNION SELECT CAST(sample_date AS DATE) FROM assay_raw
  UNION SELECT CAST(result_date AS DATE) FROM assay_raw),
n AS (
  SELECT 'dim_equipment' AS table_name, count(DISTINCT equipment_id) AS stored_rows FROM sensor_raw
  UNION ALL SELECT 'dim_location', count(DISTINCT bench_id) FROM sensor_raw
  UNION ALL SELECT 'dim_time', count(d) FROM dates
  UNION ALL SELECT 'fact_sensor_readings', count(*) FROM fact_sensor
  UNION ALL SELECT 'fact_assay_results', count(*) FROM fact_assay)
SELECT table_name, stored_rows, 2 AS n_loads, 1 AS n_rejected FROM n""",

    "table_comments": BASE + f"""
SELECT 'fact_sensor_readings' AS table_name, '{_SENSOR_NOTE}' AS comment, count(*) AS stored_rows FROM fact_sensor
UNION ALL SELECT 'fact_assay_results', '{_ASSAY_NOTE}', count(*) FROM fact_assay""",

    "reading_lookups": BASE + """,
found AS (
  SELECT 'day' AS lookup, * FROM fact_sensor WHERE CAST("timestamp" AS DATE) = DATE '2024-01-20'
  UNION ALL SELECT 'equipment on bench', * FROM fact_sensor WHERE equipment_id = 'signup' AND bench_id = 'BENCH-105'
  UNION ALL SELECT 'readings', * FROM fact_sensor WHERE reading_id IN (3, 70, 9999))
SELECT lookup, reading_id, CAST(sensor_cu_grade AS DOUBLE) AS sensor_cu_grade, qc_passed FROM found""",

    "kpi_positions": BASE + """
SELECT equipment_id, mae, row_number() OVER (ORDER BY mae NULLS LAST, equipment_id NULLS LAST) AS position FROM kpis""",

    "monthly_positions": BASE + f"""
SELECT month, bench_id, total_loads,
       row_number() OVER (ORDER BY month NULLS LAST, bench_id NULLS LAST) AS position
FROM (SELECT {_MONTHS} AS month, bench_id, count(*) AS total_loads
      FROM fact_sensor s LEFT JOIN fact_assay a ON s.reading_id = a.reading_id WHERE qc_passed GROUP BY 1, 2)""",

    "quality_positions": BASE + f"""
SELECT *, row_number() OVER (ORDER BY qc_pass_rate_pct NULLS LAST, equipment_id NULLS LAST) AS position
FROM (SELECT equipment_id, {ratio('count(*) FILTER (WHERE qc_passed) * 10000', 'count(*)', 2)} AS qc_pass_rate_pct
      FROM fact_sensor GROUP BY equipment_id)""",

    "outlier_positions": BASE + """
SELECT *, row_number() OVER (ORDER BY lecturas_outliers DESC, bench_id NULLS LAST) AS position
FROM (SELECT bench_id, count(*) AS lecturas_outliers FROM fact_sensor WHERE is_outlier GROUP BY bench_id)""",

    "reading_positions": BASE + """
SELECT ingest_seq, reading_id, full_date, row_number() OVER (ORDER BY full_date NULLS LAST, ingest_seq) AS position
FROM (SELECT *, CAST("timestamp" AS DATE) AS full_date FROM sensor_raw)""",

    "first_readings": BASE + f"""
SELECT {proj(RAW_COLS)} FROM (SELECT * FROM sensor_raw ORDER BY ingest_seq LIMIT 5)""",

    "median_sketch_accuracy": """
SELECT l_returnflag, count(l_extendedprice) AS n_values, true AS is_near_median
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_shipdate IS NOT NULL AND l_extendedprice IS NOT NULL
GROUP BY l_returnflag""",
}

# A written-and-read-back fact equals the fact computed in memory.
ORACLE["full_refresh_roundtrip"] = ORACLE["fact_sensor"]
ORACLE["clean_csv_roundtrip"] = ORACLE["clean_parquet_roundtrip"] = ORACLE["transform_sensor"]
ORACLE["assay_csv_roundtrip"] = ORACLE["transform_assay"]
ORACLE["warehouse_report_kpis"] = ORACLE["equipment_kpis"]
ORACLE["append_roundtrip"] = ORACLE["fact_sensor"]
ORACLE["append_reconciliation"] = ORACLE["reconciliation"]
ORACLE["clean_assay_csv_roundtrip"] = ORACLE["transform_assay"]
