"""One ETL run: transform, build dimensions, load (the reference's main job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orebridge.plans.assay import assay_fact
from orebridge.plans.dims import build_dim_equipment, build_dim_location, build_dim_time
from orebridge.plans.sensor import RawStatistics, raw_statistics, sensor_fact
from orebridge.plans.warehouse import Warehouse, run_concurrently


def _is_csv(path: str) -> bool:
    return path.rstrip("/").endswith(".csv")


def extract(spark: SparkSession, sensor_path: str, assay_path: str) -> tuple[DataFrame, DataFrame]:
    """Raw sensor readings and assay results (A1, A2): typed CSV, or Parquet folders."""
    from orebridge.sources import read_assay_csv, read_sensor_csv, read_sensor_parquet
    sensor = read_sensor_csv(spark, sensor_path) if _is_csv(sensor_path) else read_sensor_parquet(spark, sensor_path)
    assay = read_assay_csv(spark, assay_path) if _is_csv(assay_path) else spark.read.parquet(assay_path)
    return sensor, assay


def run_etl(sensor_raw: DataFrame, assay_raw: DataFrame, warehouse: Warehouse,
            refresh: bool = True, stats: RawStatistics | None = None) -> dict[str, int]:
    """Load raw sensor and assay rows into the warehouse; returns rows written per table.
    `stats`: the readings' statistics with repeated readings, if known already.

    refresh=True replaces all five tables (the daily full refresh, A11);
    refresh=False inserts new dimension members and appends checked facts.
    """
    mode = "overwrite" if refresh else "append"
    load = warehouse.begin_load()
    # One pass over the raw readings feeds medians, bounds, first arrivals and the three
    # dimensions; a second one writes the fact.
    stats = stats or raw_statistics(sensor_raw, repeated=True)
    # Facts and dimensions are staged side by side; every check runs before the load is
    # committed.
    dims, staged = run_concurrently(
        warehouse.spark,
        lambda: warehouse.stage_dimensions(
            build_dim_equipment(stats.equipment()), build_dim_location(stats.benches()),
            build_dim_time(sensor_raw, assay_raw, stats.dates()), mode=mode),
        lambda: warehouse.stage_facts(sensor_fact(sensor_raw, stats), assay_fact(assay_raw), load,
                                      busiest_day=stats.busiest_day()))
    return warehouse.load_facts(None, None, mode=mode, staged=staged, dims=dims)
