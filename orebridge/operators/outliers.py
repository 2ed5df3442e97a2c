"""k-sigma outlier detection with bounds from one global aggregate.

The bounds are a one-row aggregate applied to every row through a scalar subquery:
no join, no cross product; the aggregate itself is partial on each task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orebridge.functions import non_negative


def moments(value_col: str) -> list:
    """The aggregates `sigma_bounds` needs, for use inside a wider aggregation."""
    v = F.col(value_col).cast("double")
    return [F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")]


def sigma_bounds(df: DataFrame, value_col: str, k: float = 3.0,
                 floor_at_zero: bool = True) -> DataFrame:
    """One row: mean, sample std, lower_limit = max(0, mean - k*std), upper_limit.

    Statistics are in double over every non-NULL value (as pandas computes them).
    With one value the std is NULL: the upper limit is NULL and the lower limit 0.
    """
    return limits_from_moments(df.agg(*moments(value_col)), k, floor_at_zero)


def limits_from_moments(stats: DataFrame, k: float = 3.0,
                        floor_at_zero: bool = True) -> DataFrame:
    """Bounds from a one-row frame holding `mean` and `std`."""
    lower = F.col("mean") - k * F.col("std")
    if floor_at_zero:
        lower = non_negative(lower)
    return stats.select("mean", "std", lower.alias("lower_limit"),
                        (F.col("mean") + k * F.col("std")).alias("upper_limit"))


def flag_outliers(df: DataFrame, value_col: str, k: float = 3.0, out: str = "is_outlier",
                  bounds_from: DataFrame | None = None, floor_at_zero: bool = True,
                  bounds: DataFrame | None = None) -> DataFrame:
    """Add `out`: value strictly above the upper or below the lower limit.

    A NULL value is not an outlier. `bounds_from` is the frame whose statistics
    define the limits (default: `df`); `bounds` gives the limits directly (a one-row
    frame with lower_limit and upper_limit, e.g. from `limits_from_moments`).
    """
    if bounds is None:
        bounds = sigma_bounds(bounds_from if bounds_from is not None else df, value_col, k,
                              floor_at_zero)
    limits = bounds.select(F.struct("lower_limit", "upper_limit")).scalar()
    v, lim = F.col(value_col), F.col("__limits")
    flag = (v > lim.getField("upper_limit")) | (v < lim.getField("lower_limit"))
    return (df.withColumn("__limits", limits)      # one subquery, evaluated once
            .withColumn(out, F.coalesce(flag, F.lit(False))).drop("__limits"))
