"""Sensor and assay inputs derived from the `events` table.

The shared test tables carry no ore data, so one sensor reading is made per event
and about 8% of readings get an assay, with the same defects the reference's
generator injects (NULL tonnage, duplicate readings that arrive later with another
tonnage, readings far above the mean) plus cases its data lacks (a fourth bench
without a lookup entry, assays of 0, one badly calibrated equipment, duplicates).
The same definitions, as SQL, feed the DuckDB oracle (see `orebridge.catalog`).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orebridge import schemas
from orebridge.functions import add_days
from orebridge.sources.files import read_table

# Fixed values of the fixture definition.
DAY_SPREAD = 60             # readings spread over event ts + (event_id % 60) days
DUPLICATE_EVERY = 333       # event_id % 333 = 7 arrives a second time
DUPLICATE_RESIDUE = 7
DUPLICATE_SEQ_OFFSET = 1_000_000_000
ASSAY_EVERY = 25            # event_id % 25 < 2 has an assay (8%)
ASSAY_RESIDUES = 2
MISCALIBRATED = "error"     # its assays read 0.2000 lower


def _grade(hundredths: Column) -> Column:
    """Integer count of 0.0001 units -> decimal(6,4)."""
    return (hundredths.cast("bigint").cast("decimal(12,0)")
            * F.lit(Decimal("0.0001")).cast("decimal(6,4)")).cast(schemas.GRADE)


def _reading_time() -> Column:
    return add_days("ts", F.col("event_id") % DAY_SPREAD)


def _props_number() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("int")


def _sensor_columns(seq: Column, tonnage: Column) -> list[Column]:
    return [
        seq.alias("ingest_seq"),
        F.col("event_id").alias("reading_id"),
        _reading_time().alias("timestamp"),
        F.col("event_type").alias("equipment_id"),
        F.concat(F.lit("BENCH-"), (100 + 5 * (F.col("user_id") % 4)).cast("string")).alias("bench_id"),
        (1000 + F.col("user_id")).cast(schemas.COORD).alias("x_coord"),
        (5000 + F.col("user_id")).cast(schemas.COORD).alias("y_coord"),
        _grade(F.round(F.col("value") * 100)).alias("sensor_cu_grade"),
        tonnage.cast(schemas.TONNAGE).alias("tonnage"),
    ]


def sensor_base(events: DataFrame) -> DataFrame:
    """One reading per event; tonnage NULL where the event's number is 0."""
    return events.select(*_sensor_columns(F.col("event_id"),
                                          F.nullif(_props_number(), F.lit(0))))


def _late_copies(events: DataFrame) -> DataFrame:
    picked = events.where(F.col("event_id") % DUPLICATE_EVERY == DUPLICATE_RESIDUE)
    return picked.select(*_sensor_columns(F.col("event_id") + DUPLICATE_SEQ_OFFSET,
                                          _props_number() + 1))


def sensor_raw_from_base(events: DataFrame) -> DataFrame:
    return sensor_base(events).unionByName(_late_copies(events))


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sensor readings with duplicates, NULL tonnage and outliers."""
    return sensor_raw_from_base(read_table(spark, sf_dir, "events"))


def assay_raw(spark: SparkSession, sf_dir: str, every_reading: bool = False) -> DataFrame:
    """Raw assay results, 2-5 days after sampling: of 8% of readings (the lab's coverage,
    for the joins), or of every reading."""
    ev = read_table(spark, sf_dir, "events")
    if not every_reading:
        ev = ev.where(F.col("event_id") % ASSAY_EVERY < ASSAY_RESIDUES)
    shift = (F.col("event_id") % DAY_SPREAD).cast("int")
    offset = (F.round(F.col("value") * 100).cast("bigint")
              - 500 * (F.col("event_id") % 11 - 5)
              - F.when(F.col("event_type") == MISCALIBRATED, 2000).otherwise(0))
    return ev.select(
        F.col("event_id").alias("assay_id"),
        F.col("event_id").alias("reading_id"),
        add_days("ts", shift).alias("sample_date"),
        add_days("ts", shift + 2 + F.col("event_id") % 4).alias("result_date"),
        _grade(F.greatest(F.lit(0), offset)).alias("assay_cu_grade"),
    )
