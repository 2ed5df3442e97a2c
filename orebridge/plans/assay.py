"""Assay transform: turnaround in days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orebridge import schemas
from orebridge.functions import elapsed_days


def transform_assay(raw: DataFrame) -> DataFrame:
    """Raw assays plus turnaround_days = (result - sample) in days, unrounded."""
    return raw.withColumn("turnaround_days", elapsed_days("sample_date", "result_date"))


def assay_fact(raw: DataFrame) -> DataFrame:
    """The rows as loaded: turnaround_days rounded HALF_UP into NUMERIC(4,1) (H13). The cast
    raises on overflow (ANSI), as an INSERT would."""
    return transform_assay(raw).withColumn(
        "turnaround_days", F.col("turnaround_days").cast(schemas.TURNAROUND)).select(*schemas.ASSAY_FACT_COLUMNS)


def mean_turnaround(assays: DataFrame) -> DataFrame:
    """One row, the mean of unrounded turnarounds (NULL when there are no assays)."""
    t = F.col("turnaround_days")
    return assays.agg((F.sum(t) / F.nullif(F.count(t), F.lit(0))).alias("mean_turnaround_days"))
