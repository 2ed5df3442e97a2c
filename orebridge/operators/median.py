"""Exact grouped median and median imputation.

`F.median` keeps every distinct value of a group in one aggregation buffer, in one
task. Here the median comes from distinct (group, value) counts, which a partial
aggregation shrinks before the shuffle, and from running counts over them
(`running_total`): one window when the count table is within a checked row bound,
otherwise range-partitioned so that no task holds more than a slice of any group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orebridge.operators.joins import (DEFAULT_MAX_BROADCAST_ROWS, all_of,
                                       broadcast_if_bounded, salted_join)
from orebridge.operators.ordering import DEFAULT_MAX_LOCAL_ROWS, running_total


def value_counts(df: DataFrame, group_cols: list[str], value_col: str,
                 count_col: str = "n") -> DataFrame:
    """Rows per distinct (group, value), NULL groups and values left out."""
    present = all_of(F.col(c).isNotNull() for c in [*group_cols, value_col])
    return (df.where(present).groupBy(*group_cols, value_col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def group_median(df: DataFrame, group_cols: list[str], value_col: str,
                 out: str = "median",
                 max_local_rows: int = DEFAULT_MAX_LOCAL_ROWS) -> DataFrame:
    """Interpolated median of `value_col` per group; NULL values and NULL groups are
    skipped (pandas `groupby().median()`). Decimal input keeps an exact midpoint."""
    return median_from_counts(value_counts(df, group_cols, value_col), group_cols,
                              value_col, out=out, max_local_rows=max_local_rows)


def median_from_counts(counts: DataFrame, group_cols: list[str], value_col: str,
                       count_col: str = "n", out: str = "median",
                       max_local_rows: int = DEFAULT_MAX_LOCAL_ROWS,
                       materialized: bool = False) -> DataFrame:
    """Median per group from distinct (group, value, count) rows, as `value_counts`
    makes them (or as a wider aggregation, e.g. grouping sets, produces them).
    `materialized=True`: `counts` is already a checkpoint or a written table."""
    group_cols = list(group_cols)
    counts = counts.select(*group_cols, value_col, F.col(count_col).alias("__n"))
    ranked = running_total(counts, [value_col], group_cols, weight="__n",
                           before="__before", total="__size", max_local_rows=max_local_rows,
                           materialized=materialized)
    lower = F.floor((F.col("__size") - 1) / 2)
    upper = F.floor(F.col("__size") / 2)

    def covers(rank):
        return (F.col("__before") <= rank) & (rank < F.col("__before") + F.col("__n"))

    picked = ranked.where(covers(lower) | covers(upper))
    return picked.groupBy(*group_cols).agg(
        ((F.min(value_col) + F.max(value_col)) / 2).alias(out))


def impute_group_median(df: DataFrame, group_cols: list[str], value_col: str,
                        medians: DataFrame | None = None,
                        max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Fill NULL `value_col` with its group's median; the row count is unchanged.

    `medians` (group cols + `median`) may be computed on another frame, e.g. on all
    raw rows before de-duplication. Rows whose group is NULL come out NULL, as pandas
    `groupby().transform` leaves them. The median table is broadcast when it has at
    most `max_broadcast_rows` rows (checked); otherwise it is joined with a salted
    shuffle join, so a group holding a large share of the rows is still split.
    """
    group_cols = list(group_cols)
    if medians is None:
        medians = group_median(df, group_cols, value_col)
    medians = medians.select(*group_cols, F.col("median").alias("__median"))
    medians, bounded = broadcast_if_bounded(medians, max_broadcast_rows)
    joined = (df.join(medians, group_cols, "left") if bounded
              else salted_join(df, medians, group_cols, "left"))
    dtype = df.schema[value_col].dataType
    has_group = all_of(F.col(c).isNotNull() for c in group_cols)
    filled = F.when(has_group, F.coalesce(F.col(value_col), F.col("__median").cast(dtype)))
    return joined.withColumn(value_col, filled).select(*df.columns)


# Sketch parameter: 2 ** 12 items keep the rank error of a merged sketch near 0.1 %.
DEFAULT_SKETCH_K = 4096


def median_sketches(df: DataFrame, group_cols: list[str], value_col: str,
                    k: int = DEFAULT_SKETCH_K) -> DataFrame:
    """One KLL quantile sketch per group, with the number of values in it. NULL groups and
    values are skipped. A sketch has a bounded size and merges, so it can be stored per load
    and combined later (`merge_sketches`) without the rows."""
    present = all_of(F.col(c).isNotNull() for c in [*group_cols, value_col])
    return (df.where(present).groupBy(*group_cols)
            .agg(F.kll_sketch_agg_double(F.col(value_col).cast("double"), F.lit(k)).alias("sketch"),
                 F.count(F.lit(1)).alias("n_values")))


def merge_sketches(sketches: DataFrame, group_cols: list[str], k: int = DEFAULT_SKETCH_K) -> DataFrame:
    """Sketches of several loads combined per group."""
    return (sketches.groupBy(*group_cols)
            .agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n_values").alias("n_values")))


def approximate_median(sketches: DataFrame, group_cols: list[str], out: str = "median") -> DataFrame:
    """Median per group read from its sketch (double): a value of the group whose rank is
    within the sketch's error of the middle. Opt-in; `group_median` is exact."""
    return sketches.select(*group_cols, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias(out))
