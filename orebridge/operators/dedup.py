"""Duplicate keys: flag every occurrence after the first, or keep only the first.

"First" needs an order; pass the arrival order (an ingest sequence, or
`sources.with_file_order` columns for Parquet). `dropDuplicates` is never used:
it keeps an arbitrary row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orebridge.operators.joins import join_on


def _asc(cols) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def keep_first(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Keep the first row of each key (NULL keys form one key, as in pandas).

    `row_number() = 1` lets Spark run a partial group limit before the shuffle, so a
    hot key is cut to one row per map task before it moves; the result comes out
    hash-partitioned on the key, which a following join on that key reuses.
    """
    w = W.partitionBy(*key_cols).orderBy(*_asc(order_cols))
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def flag_duplicates(df: DataFrame, key_cols: list[str], order_cols: list[str],
                    out: str = "is_duplicate", row_id: list[str] | None = None) -> DataFrame:
    """Add `out`: TRUE on every row of a key after the first in `order_cols` order.

    The first order value per key comes from a hash aggregation (partial on the map
    side), or from `keep_first` when there are several order columns (group limit
    before the shuffle), then joins back on key + order value. Because the order value is part of
    the join key, the rows of one hot key spread over all tasks. The order must be
    unique within a key (an arrival sequence is); NULL keys count as one key.

    `row_id`: columns that identify a row (e.g. the file position), used as the last
    sort keys; the join back then matches on key + row_id only, not on every
    order column.
    """
    key_cols, order_cols = list(key_cols), list(order_cols)
    if row_id:
        order_cols = order_cols + [c for c in row_id if c not in order_cols]
    # columns matched in the join back: the row id when there is one, else the order
    match = list(row_id) if row_id and len(order_cols) > 1 else order_cols
    if len(order_cols) == 1:
        # min() skips NULLs: NULL order values come last, as in keep_first
        firsts = df.groupBy(*key_cols).agg(F.min(order_cols[0]).alias(order_cols[0]))
    else:
        firsts = keep_first(df.select(*dict.fromkeys(key_cols + order_cols)), key_cols, order_cols)
        firsts = firsts.select(*key_cols, *match)
    firsts = firsts.withColumn("__is_first", F.lit(True))
    joined = join_on(df, firsts, key_cols + match, "left", null_safe=True)
    return (joined.withColumn(out, F.col("__is_first").isNull())
            .select(*df.columns, out))
