"""Defect injection: NULL a column, scale a column, append copies of rows.

Rows are picked by a stable rule on an integral key, `pmod(key + salt, m) < k` for a
rate k/m, so a rerun (or a retried task) picks the same rows and the result can be
checked in SQL. The rate is met exactly for consecutive keys, approximately
otherwise (as a seeded sample is).
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F


def pick(key: str, rate: float, salt: int = 0) -> Column:
    """TRUE on about `rate` of the rows; a NULL key is never picked."""
    frac = Fraction(rate).limit_denominator(1_000_000)
    if frac <= 0:
        return F.lit(False)
    return F.coalesce(F.pmod(F.col(key) + salt, F.lit(frac.denominator)) < frac.numerator,
                      F.lit(False))


def null_some(df: DataFrame, col: str, picked: Column) -> DataFrame:
    return df.withColumn(col, F.when(~picked, F.col(col)))


def scale_some(df: DataFrame, col: str, picked: Column, factor) -> DataFrame:
    dtype = df.schema[col].dataType
    return df.withColumn(col, F.when(picked, (F.col(col) * factor).cast(dtype))
                         .otherwise(F.col(col)))


def inject_defects(df: DataFrame, key: str = "reading_id", null_col: str = "tonnage",
                   scale_col: str = "sensor_cu_grade", null_rate: float = 0.01,
                   outlier_rate: float = 0.005, duplicate_rate: float = 0.003,
                   factor: int = 10, salts: tuple[int, int, int] = (1, 2, 3),
                   seq_col: str | None = "ingest_seq", seq_offset: int = 1 << 62) -> DataFrame:
    """NULL `null_col` on `null_rate` of rows, multiply `scale_col` by `factor` on
    `outlier_rate`, then append copies of `duplicate_rate` of the modified rows.

    Copies arrive later: their `seq_col` (if present) is shifted by `seq_offset`
    (2^62: above any scan-derived sequence, see `read_sensor_csv`, below overflow).
    Scaling raises if the result no longer fits the column type (ANSI).
    """
    out = null_some(df, null_col, pick(key, null_rate, salts[0]))
    out = scale_some(out, scale_col, pick(key, outlier_rate, salts[1]), factor)
    copies = out.where(pick(key, duplicate_rate, salts[2]))
    if seq_col and seq_col in df.columns:
        copies = copies.withColumn(seq_col, F.col(seq_col) + F.lit(seq_offset))
    return out.unionByName(copies)
