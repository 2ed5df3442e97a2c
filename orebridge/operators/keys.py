"""Key integrity checks and key-aware loading.

Checks return the offending keys (empty frame = passes) so that callers can show
them; `assert_all_empty` turns several checks into one precondition, run as one job. Every check aggregates
per key before any join, so a key holding a third of the rows moves as one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orebridge.operators.joins import all_of
from orebridge.operators.ordering import running_total


class KeyCheckError(ValueError):
    """A primary-key, NOT NULL or foreign-key check failed."""


def key_violations(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys that occur more than once or are (partly) NULL, with their row counts."""
    key_cols = list(key_cols)
    any_null = ~all_of(F.col(c).isNotNull() for c in key_cols)
    counts = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | any_null)


def fk_orphans(child: DataFrame, parent: DataFrame, child_cols: list[str],
               parent_cols: list[str] | None = None) -> DataFrame:
    """Non-NULL child keys absent from the parent, with their row counts.

    The child is reduced to distinct keys (partial aggregation) before the anti-join.
    """
    child_cols = list(child_cols)
    parent_cols = list(parent_cols or child_cols)
    present = all_of(F.col(c).isNotNull() for c in child_cols)
    keys = child.where(present).groupBy(*child_cols).agg(F.count(F.lit(1)).alias("n_rows"))
    parent_keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, child_cols)]).distinct()
    return keys.join(parent_keys, child_cols, "left_anti")


def key_usage(frames: dict[str, DataFrame], key_cols: list[str]) -> DataFrame:
    """One row per key of any frame (NULL being a key), with the number of rows each frame has
    of it in a column of the frame's name: the key checks between several frames with a single
    shuffle of slim, partly aggregated keys."""
    parts = [df.select(*key_cols, *[F.lit(int(n == name)).cast("long").alias(n) for n in frames])
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts).groupBy(*key_cols).agg(*[F.sum(n).alias(n) for n in frames])


def assert_empty(check: DataFrame, what: str) -> None:
    assert_all_empty({what: check})


def null_rows(df: DataFrame, cols: list[str]) -> dict[str, DataFrame]:
    """One "must be empty" check per NOT NULL column: the rows holding a NULL."""
    return {f"NULL in {c}": df.where(F.col(c).isNull()).select(c) for c in cols}


def long_values(df: DataFrame, limits: dict[str, int]) -> dict[str, DataFrame]:
    """One "must be empty" check per VARCHAR(n) column: the rows holding a longer text."""
    return {f"{c} longer than {n}": df.where(F.length(c) > n).select(c) for c, n in limits.items()}


def declared_checks(not_null: list[str], varchar: dict[str, int]) -> dict[str, tuple[Column, str]]:
    """The same as row checks for `failed_rows`: name -> (condition that must hold in no row,
    column to show)."""
    return {**{f"NULL in {c}": (F.col(c).isNull(), c) for c in not_null},
            **{f"{c} longer than {n}": (F.length(c) > n, c) for c, n in varchar.items()}}


_FOUND = "array<struct<check:string,n:bigint,low:string,high:string>>"


def failed_rows(df: DataFrame, checks: dict[str, tuple]) -> DataFrame:
    """Row checks that fail, with the number of offending rows and the smallest and largest
    offending value as JSON. All checks share one scan of `df`. A check is (condition, column
    or list of columns to show), and a column to add up in place of the number of rows if `df`
    has counts."""
    found = []
    for name, (cond, shown, *n) in checks.items():
        value = F.when(cond, F.to_json(F.struct(shown)))
        rows = F.coalesce(F.sum(F.when(cond, n[0])), F.lit(0)) if n else F.count_if(cond)
        found.append(F.struct(F.lit(name).alias("check"), rows.alias("n"),
                              F.min(value).alias("low"), F.max(value).alias("high")))
    rows = df.agg(F.array(*found).cast(_FOUND).alias("found"))
    return rows.select(F.inline("found")).where("n > 0")


def assert_all_empty(checks: dict[str, DataFrame], row_checks: list[DataFrame] = ()) -> None:
    """Run several "must be empty" checks, and row checks (`failed_rows`), as one job; raise
    naming every failed check with its number of offending rows and two of them (the smallest
    and largest as JSON)."""
    parts = [df.select(F.to_json(F.struct("*")).alias("row"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("low"), F.max("row").alias("high"))
             .where("n > 0").select(F.lit(name).alias("check"), "n", "low", "high")
             for name, df in checks.items()] + list(row_checks)
    if not parts:
        return
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    bad = union.collect()
    if bad:
        raise KeyCheckError("; ".join(
            f"{r.check}: {r.n} rows, e.g. {sorted({r.low, r.high})}" for r in bad))


def insert_if_absent(incoming: DataFrame, existing: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of `incoming` whose key is not in `existing` (INSERT .. ON CONFLICT DO NOTHING).

    Within `incoming` the keys must already be distinct.
    """
    return incoming.join(existing.select(*key_cols), list(key_cols), "left_anti")


def assign_surrogate_keys(df: DataFrame, out: str, order_cols: list[str],
                          start_after=None, materialized: bool = False) -> DataFrame:
    """Add `out` = 1, 2, ... in `order_cols` order, after `start_after` (a Column such as
    a scalar subquery of the existing maximum, or an int). Small inputs (checked, see
    `running_total`) are numbered by one window in one task, larger ones range by range."""
    base = F.lit(0).cast("long") if start_after is None else (
        F.lit(start_after).cast("long") if isinstance(start_after, int) else start_after)
    numbered = running_total(df, list(order_cols), before="__pos", materialized=materialized)
    return (numbered.withColumn(out, F.coalesce(base, F.lit(0).cast("long")) + F.col("__pos") + 1)
            .select(out, *df.columns))


def max_key(existing: DataFrame, key: str):
    """Scalar subquery: the largest existing surrogate key, 0 when the table is empty."""
    return existing.select(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()


__all__ = ["KeyCheckError", "assert_all_empty", "assert_empty", "assign_surrogate_keys",
           "declared_checks", "failed_rows", "fk_orphans", "insert_if_absent", "key_usage", "key_violations", "long_values", "max_key", "null_rows"]
