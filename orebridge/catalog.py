"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the shared test tables (directly or through the fixture inputs derived
from `events`) and runs a library operator or plan over them whole. Decimal
outputs are cast to double at this boundary only, so results compare across
engines; the library itself returns exact decimals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orebridge import plans, schemas
from orebridge.functions import as_double
from orebridge.operators import (KeyCheckError, approximate_median, attach, fk_orphans, flag_duplicates,
                                 flag_outliers, group_median, impute_group_median, inject_defects,
                                 insert_if_absent, keep_first, key_violations, max_key, median_sketches,
                                 merge_sketches, with_position)
from orebridge.plans.dims import distinct_dates, time_attributes
from orebridge.plans.warehouse import FACTS, Warehouse
from orebridge.session import reliable_checkpoint, scratch_path
from orebridge.sources import (assay_raw, read_assay_csv, read_csv, read_sensor_csv, read_table, sensor_base,
                               sensor_raw, with_file_order, write_csv, write_parquet)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameter of the run summary on the fixtures: every turnaround there is 2-5 days,
# so the SLA limit is set to 4 to make the count non-trivial.
FIXTURE_SLA_DAYS = 4


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


def facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return plans.sensor_fact(sensor_raw(spark, sf_dir)), plans.assay_fact(assay_raw(spark, sf_dir))


def paired_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both facts for an inner join: readings without an assay leave before any shuffle."""
    assay = plans.assay_fact(assay_raw(spark, sf_dir))
    return plans.paired_sensor_fact(sensor_raw(spark, sf_dir), assay), assay


# ---- duplicates
@register("duplicate_flags")
def q_duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_duplicates(sensor_raw(spark, sf_dir), ["reading_id"], ["ingest_seq"])


@register("dedup_keep_first")
def q_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(sensor_raw(spark, sf_dir), ["reading_id"], ["ingest_seq"])


@register("dedup_lineitem")
def q_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    return keep_first(li, key, [c for c in li.columns if c not in key])


@register("lineitem_duplicate_flags")
def q_lineitem_duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row flagged; order = the other columns, then file position."""
    li = read_table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    order = [c for c in li.columns if c not in key]
    flagged = flag_duplicates(with_file_order(li), key, order, row_id=["ingest_file", "ingest_row"])
    return flagged.drop("ingest_file", "ingest_row")


# ---- median and imputation
@register("group_median")
def q_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_median(sensor_raw(spark, sf_dir), ["equipment_id"], "tonnage")


@register("impute_group_median")
def q_impute_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute_group_median(sensor_raw(spark, sf_dir), ["equipment_id"], "tonnage")


@register("lineitem_price_median")
def q_lineitem_price_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same exact median on another table: three groups of about a third each."""
    li = read_table(spark, sf_dir, "lineitem")
    return group_median(li, ["l_returnflag"], "l_extendedprice")


# ---- outliers
@register("outlier_bounds")
def q_outlier_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = plans.outlier_bounds(sensor_raw(spark, sf_dir))
    return b.select(*[F.round(c, 8).alias(c) for c in b.columns])


@register("outlier_flags")
def q_outlier_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_outliers(sensor_raw(spark, sf_dir), "sensor_cu_grade")


# ---- transforms and facts
@register("transform_sensor")
def q_transform_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.transform_sensor(sensor_raw(spark, sf_dir))


@register("qc_counters")
def q_qc_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.qc_counters(sensor_raw(spark, sf_dir))


@register("transform_assay")
def q_transform_assay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.transform_assay(assay_raw(spark, sf_dir, every_reading=True))


@register("fact_sensor")
def q_fact_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.sensor_fact(sensor_raw(spark, sf_dir))


@register("fact_assay")
def q_fact_assay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.assay_fact(assay_raw(spark, sf_dir, every_reading=True))


# ---- dimensions
@register("dim_equipment")
def q_dim_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.build_dim_equipment(sensor_raw(spark, sf_dir))


@register("dim_location")
def q_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (plans.with_location_ids(plans.build_dim_location(sensor_raw(spark, sf_dir)))
            .orderBy("location_id"))


@register("dim_time")
def q_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = plans.with_time_ids(plans.build_dim_time(sensor_raw(spark, sf_dir),
                                                   assay_raw(spark, sf_dir, every_reading=True)))
    return dim.orderBy("full_date")          # dates ascending (F5)


@register("dim_insert_new")
def q_dim_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time dimension loaded from sensor dates, then assay dates inserted if absent."""
    existing = plans.with_time_ids(time_attributes(
        distinct_dates((sensor_raw(spark, sf_dir), "timestamp"))))
    assays = assay_raw(spark, sf_dir, every_reading=True)
    incoming = time_attributes(distinct_dates((assays, "sample_date"), (assays, "result_date")))
    new = insert_if_absent(incoming, existing, ["full_date"])
    return plans.with_time_ids(new, start_after=max_key(existing, "time_id"))


# ---- key checks
@register("fk_orphans")
def q_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assays whose reading is not a QC-passed reading (they leave the reconciliation)."""
    sensor, assay = facts(spark, sf_dir)
    return fk_orphans(assay, sensor.where(F.col("qc_passed")), ["reading_id"])


@register("key_violations")
def q_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(sensor_raw(spark, sf_dir), ["reading_id"])


# ---- views and report
@register("reconciliation")
def q_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.reconciliation(*paired_facts(spark, sf_dir))


@register("equipment_kpis")
def q_equipment_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.equipment_kpis(plans.reconciliation(*paired_facts(spark, sf_dir)))


@register("calibration_status")
def q_calibration_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = plans.equipment_kpis(plans.reconciliation(*paired_facts(spark, sf_dir)))
    return plans.calibration_report(kpis)


@register("calibration_lines")
def q_calibration_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = plans.equipment_kpis(plans.reconciliation(*paired_facts(spark, sf_dir)))
    return plans.calibration_messages(kpis)


@register("monthly_grade_trend")
def q_monthly_grade_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, assay = sensor_raw(spark, sf_dir), plans.assay_fact(assay_raw(spark, sf_dir))
    stats = plans.raw_statistics(raw)
    return plans.monthly_grade_trend(plans.sensor_fact(raw, stats), assay,
                                     plans.paired_sensor_fact(raw, assay, stats))


@register("data_quality_report")
def q_data_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.data_quality_report(plans.sensor_fact(sensor_raw(spark, sf_dir)))


@register("turnaround_summary")
def q_turnaround_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.turnaround_summary(plans.assay_fact(assay_raw(spark, sf_dir, every_reading=True)))


def _hourly_assays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assays of every reading whose results also take some hours: unrounded turnarounds."""
    hours = (F.col("assay_id") % 24).cast("int")
    return assay_raw(spark, sf_dir, every_reading=True).withColumn(
        "result_date", F.col("result_date") + F.make_dt_interval(hours=hours))


@register("mean_turnaround")
def q_mean_turnaround(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the unrounded turnarounds (D20), to 6 places."""
    mean = plans.mean_turnaround(plans.transform_assay(_hourly_assays(spark, sf_dir)))
    return mean.select(F.round("mean_turnaround_days", 6).alias("mean_turnaround_days"))


@register("turnaround_lines")
def q_turnaround_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's turnaround sentences (H17) over loaded, rounded turnarounds."""
    return plans.turnaround_messages(plans.turnaround_summary(plans.assay_fact(_hourly_assays(spark, sf_dir))))


@register("table_row_counts")
def q_table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all five tables after a full refresh (A14), and the counts observed
    during the writes (A15)."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    observed = plans.run_etl(sensor_raw(spark, sf_dir), assay_raw(spark, sf_dir), wh, refresh=True)
    rows = [(name, wh.row_count(name), observed[name]) for name in schemas.TABLES]
    return spark.createDataFrame(rows, "table_name string, stored_rows long, observed_rows long")


@register("csv_arrival_order")
def q_csv_arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings written as CSV files without a sequence column, read back in arrival
    order (A1): the first row of each reading, by file and line."""
    path = scratch_path(spark, "sensor_csv")
    raw = sensor_raw(spark, sf_dir)
    ordered = raw.repartitionByRange(4, "ingest_seq").sortWithinPartitions("ingest_seq")
    write_csv(ordered.select(*schemas.SENSOR_CSV.fieldNames()), path)
    first = keep_first(read_sensor_csv(spark, path), ["reading_id"], ["ingest_seq"])
    return first.drop("ingest_seq")


@register("outliers_by_bench")
def q_outliers_by_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.outliers_by_bench(plans.sensor_fact(sensor_raw(spark, sf_dir)))


@register("run_summary")
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.run_summary(*facts(spark, sf_dir), sla_days=FIXTURE_SLA_DAYS)


# ---- defect injection
@register("inject_defects")
def q_inject_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject_defects(sensor_base(read_table(spark, sf_dir, "events")))


# ---- sinks read back
@register("clean_csv_roundtrip")
def q_clean_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned sensor set written as CSV (as the transform does) and read back."""
    cleaned = plans.transform_sensor(sensor_raw(spark, sf_dir))
    path = scratch_path(spark, "sensor_clean_csv")
    write_csv(cleaned, path)
    return read_csv(spark, path, cleaned.schema)


@register("clean_parquet_roundtrip")
def q_clean_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned sensor set written as Parquet and read back (A5)."""
    path = scratch_path(spark, "sensor_clean_parquet")
    write_parquet(plans.transform_sensor(sensor_raw(spark, sf_dir)), path)
    return spark.read.parquet(path)


@register("assay_csv_roundtrip")
def q_assay_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw assays written as CSV, read with the typed reader (A2) and transformed."""
    path = scratch_path(spark, "assay_csv")
    raw = assay_raw(spark, sf_dir, every_reading=True)
    write_csv(raw.select(*schemas.ASSAY_RAW.fieldNames()), path)
    return plans.transform_assay(read_assay_csv(spark, path))


@register("full_refresh_roundtrip")
def q_full_refresh_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full ETL into a fresh warehouse folder (shared storage), the sensor fact read back."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    plans.run_etl(sensor_raw(spark, sf_dir), assay_raw(spark, sf_dir), wh, refresh=True)
    return wh.table("fact_sensor_readings").select(*schemas.SENSOR_FACT_COLUMNS)


@register("warehouse_report_kpis")
def q_warehouse_report_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full ETL into a fresh bucketed warehouse, then the KPI view read by name (A13,
    A17) over the stored facts; the fact join there needs no shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))     # the caller's parallelism
    wh = Warehouse(spark, scratch_path(spark, "warehouse_bucketed"), buckets=buckets)
    plans.run_etl(sensor_raw(spark, sf_dir), assay_raw(spark, sf_dir), wh, refresh=True)
    return plans.warehouse_report(wh)["equipment_kpis"]


# ---- loads in several steps
# Parameter: readings before this time come with the first load, later ones with the second.
SECOND_LOAD_FROM = "2024-02-10 00:00:00"


def _loaded_in_two_steps(spark: SparkSession, raw: DataFrame, raw_assay: DataFrame,
                         stats: plans.RawStatistics) -> Warehouse:
    """A refresh with the earlier readings and their assays, then a checked append of the
    rest, which brings new dates for the time dimension. `stats`: the raw readings' statistics
    with repeated readings.

    Each load reads the rows once, to write them; its dimensions come from what it has written."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse_append"))
    sensor, assay = plans.first_sensor_fact(raw, stats), plans.assay_fact(raw_assay)
    busiest_day = stats.busiest_day()
    for early, mode in ((True, "overwrite"), (False, "append")):
        def batch(df: DataFrame, time: str) -> DataFrame:
            before = F.col(time) < F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
            return df.where(before if early else ~before)
        staged = wh.stage_facts(batch(sensor, "timestamp"), batch(assay, "sample_date"), busiest_day=busiest_day)
        dims = wh.stage_dimensions(plans.build_dim_equipment(staged.sensor), plans.build_dim_location(staged.sensor),
                                   plans.build_dim_time(staged.sensor, staged.assay), mode=mode)
        wh.load_facts(None, None, mode=mode, staged=staged, dims=dims)
    return wh


def _load_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, plans.RawStatistics]:
    """Raw readings, raw assays and the readings' statistics, for several loads: the assays (few,
    each load reads them several times) and the statistics are computed once."""
    raw = sensor_raw(spark, sf_dir)
    return raw, reliable_checkpoint(assay_raw(spark, sf_dir)), plans.raw_statistics(raw, repeated=True)


@register("append_roundtrip")
def q_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensor fact after a refresh and an append, read by its SQL name."""
    wh = _loaded_in_two_steps(spark, *_load_inputs(spark, sf_dir))
    return spark.table(wh.catalog_name("fact_sensor_readings")).select(*schemas.SENSOR_FACT_COLUMNS)


@register("append_reconciliation")
def q_append_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation view after a refresh and an append: both facts in both loads."""
    return _loaded_in_two_steps(spark, *_load_inputs(spark, sf_dir)).register_views()["reconciliation"]


@register("append_row_counts")
def q_append_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the five tables after a refresh, an append and an append that is rejected for
    its keys, which leaves every table as it was (A8, A12)."""
    raw, raw_assay, stats = _load_inputs(spark, sf_dir)
    wh = _loaded_in_two_steps(spark, raw, raw_assay, stats)
    try:
        plans.run_etl(raw, raw_assay, wh, refresh=False, stats=stats)
        rejected = 0
    except KeyCheckError:
        rejected = 1
    rows = [(name, wh.row_count(name), len(wh.live_loads(name)), rejected) for name in schemas.TABLES]
    return spark.createDataFrame(rows, "table_name string, stored_rows long, n_loads int, n_rejected int")


@register("table_comments")
def q_table_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of the fact tables as the catalog shows them (A18), with their rows."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    plans.run_etl(sensor_raw(spark, sf_dir), assay_raw(spark, sf_dir), wh, refresh=True)
    listed = {t.name: t.description for t in spark.catalog.listTables(wh.database)}
    rows = [(name, listed[name], spark.table(wh.catalog_name(name)).count()) for name in FACTS]
    return spark.createDataFrame(rows, "table_name string, comment string, stored_rows long")


@register("reading_lookups")
def q_reading_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lookups on the stored fact, as its indexes serve them (A19): a day, an equipment
    on a bench, single readings."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    plans.run_etl(sensor_raw(spark, sf_dir), assay_raw(spark, sf_dir), wh, refresh=True)
    fact = wh.table("fact_sensor_readings")
    found = {
        "day": wh.rows_between("fact_sensor_readings", dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21)),
        "equipment on bench": fact.where("equipment_id = 'signup' AND bench_id = 'BENCH-105'"),
        "readings": fact.where("reading_id IN (3, 70, 9999)"),
    }
    parts = [df.select(F.lit(name).alias("lookup"), "reading_id", "sensor_cu_grade", "qc_passed")
             for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("clean_assay_csv_roundtrip")
def q_clean_assay_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned assay set written as CSV (A4) and read back."""
    cleaned = plans.transform_assay(assay_raw(spark, sf_dir, every_reading=True))
    path = scratch_path(spark, "assay_clean_csv")
    write_csv(cleaned, path)
    return read_csv(spark, path, cleaned.schema)


# ---- ordered outputs: the order is part of the rows
@register("kpi_positions")
def q_kpi_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs by MAE (F1); equal ones by equipment."""
    kpis = plans.equipment_kpis(plans.reconciliation(*paired_facts(spark, sf_dir)))
    return with_position(kpis.select("equipment_id", "mae"),
                         [F.col("mae").asc_nulls_last(), F.col("equipment_id").asc_nulls_last()])


@register("monthly_positions")
def q_monthly_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly view by month and bench (F2)."""
    rows = q_monthly_grade_trend(spark, sf_dir).select("month", "bench_id", "total_loads")
    return with_position(rows, [F.col("month").asc_nulls_last(), F.col("bench_id").asc_nulls_last()])


@register("quality_positions")
def q_quality_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data quality by pass rate (F3); equal ones by equipment."""
    rows = plans.data_quality_report(plans.sensor_fact(sensor_raw(spark, sf_dir)))
    return with_position(rows.select("equipment_id", "qc_pass_rate_pct"),
                         [F.col("qc_pass_rate_pct").asc_nulls_last(), F.col("equipment_id").asc_nulls_last()])


@register("outlier_positions")
def q_outlier_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benches by their outliers, most first (F4); equal ones by bench."""
    rows = plans.outliers_by_bench(plans.sensor_fact(sensor_raw(spark, sf_dir)))
    return with_position(rows, [F.col("lecturas_outliers").desc_nulls_first(), F.col("bench_id").asc_nulls_last()])


@register("reading_positions")
def q_reading_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw reading numbered by date (F5), then arrival, range by range: no task sorts
    all rows."""
    rows = sensor_raw(spark, sf_dir).select("ingest_seq", "reading_id", F.to_date("timestamp").alias("full_date"))
    return with_position(rows, [F.col("full_date").asc_nulls_last(), F.col("ingest_seq").asc()], max_local_rows=0)


@register("first_readings")
def q_first_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five raw readings to arrive (F6), a top-k without a full sort."""
    return sensor_raw(spark, sf_dir).orderBy("ingest_seq").limit(5)


# ---- mergeable quantile sketch (D2, opt-in)
@register("median_sketch_accuracy")
def q_median_sketch_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price medians of lineitem from sketches made per ship year and merged: the values
    behind each and whether its rank is within 1 % of the middle."""
    li = read_table(spark, sf_dir, "lineitem")
    by_year = median_sketches(li.withColumn("year", F.year("l_shipdate")), ["l_returnflag", "year"], "l_extendedprice")
    merged = merge_sketches(by_year, ["l_returnflag"])
    medians = approximate_median(merged, ["l_returnflag"])
    price, median = F.col("l_extendedprice").cast("double"), F.col("median")
    ranks = (attach(li.select("l_returnflag", "l_extendedprice"), medians, ["l_returnflag"], "inner")
             .groupBy("l_returnflag").agg(F.count_if(price < median).alias("below"),
                                          F.count_if(price <= median).alias("up_to"), F.count(price).alias("n")))
    near = (F.col("below") <= 0.51 * F.col("n")) & (F.col("up_to") >= 0.49 * F.col("n"))
    return ranks.join(merged, "l_returnflag").select("l_returnflag", "n_values", near.alias("is_near_median"))


def queries() -> dict[str, Query]:
    """Registered queries, with decimal outputs cast to double for comparison."""
    def comparable(fn: Query) -> Query:
        return lambda spark, sf_dir: as_double(fn(spark, sf_dir))
    return {name: comparable(fn) for name, fn in QUERIES.items()}
