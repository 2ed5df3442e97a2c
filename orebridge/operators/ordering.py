"""Running totals in a sort order, split across tasks when the input is large.

A window `sum(w) OVER (PARTITION BY g ORDER BY v)` puts every row of a group in one
task, so one hot group (a third of the data) becomes one task. The input is first
materialised once (reliable checkpoint). If it holds at most `max_local_rows` rows
(checked), that plain window is bounded work and is used. Otherwise the rows are
range-partitioned on (g, v): a hot group spans many partitions, each task computes
local running sums, and the per-partition group totals (at most one row per
partition and group) give every partition its offset.

The range-partitioned frame is checkpointed before its partition ids are used
twice: re-sampling the range bounds on a recomputation (e.g. after an executor
loss) must not move rows between partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orebridge.operators.joins import broadcast_if_bounded, join_on
from orebridge.session import reliable_checkpoint


# Inputs up to this many rows are numbered with one plain window (bounded work).
DEFAULT_MAX_LOCAL_ROWS = 1_000_000


def running_total(df: DataFrame, order_cols: list[str], group_cols: list[str] = (),
                  weight: str | None = None, before: str = "_before",
                  total: str | None = None,
                  max_local_rows: int = DEFAULT_MAX_LOCAL_ROWS,
                  materialized: bool = False) -> DataFrame:
    """Add `before` = sum of `weight` (1 per row if None) over rows that sort before
    this one within its group; and `total` = the group's sum, if asked for.

    Order is ascending with NULLs first. (group, order) values should be distinct,
    as they are for the callers here (distinct keys, or counts per distinct value):
    equal values cannot be split across range partitions, and among ties the
    running sum would depend on an arbitrary order. `materialized=True` says `df` is already a checkpoint or a written table, so
    reading it twice is cheap and it is not staged again.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    staged = df.withColumn("__w", w)
    if not materialized:
        staged = reliable_checkpoint(staged)
    if staged.count() <= max_local_rows:
        out = _window_totals(staged, order_cols, group_cols, before, total)
    else:
        out = _distributed_totals(staged, order_cols, group_cols, before, total)
    return out.drop("__w")


def _zero():
    return F.lit(0).cast("long")


def _window_totals(staged, order_cols, group_cols, before, total):
    grp = W.partitionBy(*group_cols)
    cols = {before: F.coalesce(F.sum("__w").over(
        grp.orderBy(*order_cols).rowsBetween(W.unboundedPreceding, -1)), _zero())}
    if total:
        cols[total] = F.sum("__w").over(grp)
    return staged.withColumns(cols)


def _distributed_totals(staged, order_cols, group_cols, before, total):
    ranged = reliable_checkpoint(staged.repartitionByRange(*group_cols, *order_cols)
                                 .withColumn("__part", F.spark_partition_id()))

    # One shuffle on (partition, group): running sum inside it and its total.
    in_part = W.partitionBy("__part", *group_cols)
    local = ranged.withColumns({
        "__local": F.coalesce(F.sum("__w").over(
            in_part.orderBy(*order_cols).rowsBetween(W.unboundedPreceding, -1)), _zero()),
        "__ptot": F.sum("__w").over(in_part),
    })

    # Offsets: one row per (partition, group), so at most partitions x groups rows.
    per_part = local.select("__part", *group_cols, "__ptot").distinct()
    across = W.partitionBy(*group_cols).orderBy("__part")
    cols = ["__part", *group_cols,
            F.coalesce(F.sum("__ptot").over(across.rowsBetween(W.unboundedPreceding, -1)),
                       _zero()).alias("__off")]
    if total:
        cols.append(F.sum("__ptot").over(W.partitionBy(*group_cols)).alias(total))
    offsets, _ = broadcast_if_bounded(per_part.select(*cols))

    out = join_on(local, offsets, ["__part", *group_cols], "inner", null_safe=True)
    return (out.withColumn(before, F.col("__off") + F.col("__local"))
            .drop("__part", "__local", "__ptot", "__off"))


def with_position(df: DataFrame, order: list[Column], out: str = "position",
                  max_local_rows: int = DEFAULT_MAX_LOCAL_ROWS) -> DataFrame:
    """Add `out` = 1, 2, ... in the order of `order` (sort columns such as
    `F.col("mae").asc_nulls_last()`), so the order of a result is part of its rows.

    Small inputs (checked) are numbered by one window. Larger ones are sorted into ranges;
    each task numbers its own and adds the rows of the ranges before, one count per
    partition. Rows that tie in `order` are numbered in any, but one fixed, way.
    """
    staged = reliable_checkpoint(df)
    if staged.count() <= max_local_rows:
        return staged.withColumn(out, F.row_number().over(W.orderBy(*order)).cast("long"))
    ranged = reliable_checkpoint(
        staged.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    # the number of a row within its partition is the lower part of its increasing id
    local = ranged.withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = local.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets, _ = broadcast_if_bounded(sizes.select("__part", F.coalesce(before, _zero()).alias("__off")))
    return (local.join(offsets, "__part").withColumn(out, F.col("__off") + F.col("__at") + 1)
            .drop("__part", "__at", "__off"))
