"""Dimension builders (I3-I5): distinct business keys plus attributes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from orebridge import schemas
from orebridge.functions import calendar_parts, to_date
from orebridge.functions.dates import DEFAULT_SHIFT
from orebridge.operators import assign_surrogate_keys

# Attributes every equipment row gets.
EQUIPMENT_TYPE = "SHOVEL"
EQUIPMENT_MODEL = "CAT 7495"
EQUIPMENT_CAPACITY = Decimal("250.0")

# Bench lookup (elevation in metres, geological zone) and defaults.
BENCH_ELEVATION = {"BENCH-100": 3100, "BENCH-105": 3095, "BENCH-110": 3090}
BENCH_ZONE = {"BENCH-100": "SULFIDE", "BENCH-105": "SULFIDE", "BENCH-110": "OXIDE"}
DEFAULT_ELEVATION = 3000
DEFAULT_ZONE = "UNKNOWN"


def _lookup(mapping: dict, key, default):
    """Literal map lookup with a default; evaluated per row in generated code, no join."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[key], F.lit(default))


def build_dim_equipment(sensor: DataFrame) -> DataFrame:
    """One row per equipment; readings without one add no member."""
    return sensor.select("equipment_id").where(F.col("equipment_id").isNotNull()).distinct().select(
        "equipment_id",
        F.lit(EQUIPMENT_TYPE).alias("equipment_type"),
        F.lit(EQUIPMENT_MODEL).alias("model"),
        F.lit(EQUIPMENT_CAPACITY).cast(schemas.TONNAGE).alias("capacity_tons"),
        F.lit(True).alias("active"),
    )


def build_dim_location(sensor: DataFrame) -> DataFrame:
    bench = F.col("bench_id")
    return sensor.select("bench_id").where(bench.isNotNull()).distinct().select(
        "bench_id",
        _lookup(BENCH_ELEVATION, bench, DEFAULT_ELEVATION).cast("int").alias("bench_elevation"),
        _lookup(BENCH_ZONE, bench, DEFAULT_ZONE).alias("zone"),
    )


def distinct_dates(*cols_by_frame: tuple[DataFrame, str]) -> DataFrame:
    """Union of the dates of several timestamp columns, de-duplicated (G1)."""
    parts = [df.select(to_date(c).alias("full_date")) for df, c in cols_by_frame]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def build_dim_time(sensor: DataFrame, assay: DataFrame, sensor_dates: DataFrame | None = None) -> DataFrame:
    """One row per date present in the data (no gap filling). `sensor_dates`: the readings'
    distinct dates (full_date), where they are known already."""
    of_readings = (sensor, "timestamp") if sensor_dates is None else (sensor_dates, "full_date")
    dates = distinct_dates(of_readings, (assay, "sample_date"), (assay, "result_date"))
    return time_attributes(dates)


def time_attributes(dates: DataFrame) -> DataFrame:
    parts = calendar_parts("full_date")
    return dates.where(F.col("full_date").isNotNull()).select(
        "full_date", *[c.alias(n) for n, c in parts.items()],
        F.lit(DEFAULT_SHIFT).alias("shift"))


def with_location_ids(dim_location: DataFrame, start_after=None,
                      materialized: bool = False) -> DataFrame:
    return assign_surrogate_keys(dim_location, "location_id", ["bench_id"], start_after,
                                 materialized)


def with_time_ids(dim_time: DataFrame, start_after=None, materialized: bool = False) -> DataFrame:
    return assign_surrogate_keys(dim_time, "time_id", ["full_date"], start_after, materialized)
