"""Exact numeric helpers.

PostgreSQL NUMERIC arithmetic is exact and rounds half away from zero. Spark's
decimal arithmetic does the same; the helpers keep measures in decimal until the
final ROUND so results do not pass through binary floating point.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, places: int) -> Column:
    """ROUND(x, n): HALF_UP on decimals, as PostgreSQL rounds NUMERIC."""
    return F.round(_col(c), places)


def exact_mean(c) -> Column:
    """AVG over non-NULL values as one decimal quotient.

    `avg(decimal(p,s))` keeps only s+4 places, which can round twice before a later
    ROUND; SUM / COUNT keeps up to 38 digits. NULL when no value is present.
    """
    c = _col(c)
    return F.sum(c) / F.nullif(F.count(c), F.lit(0))


def non_negative(c) -> Column:
    """max(0, x); NULL stays out (GREATEST skips NULL)."""
    return F.greatest(F.lit(0), _col(c))


def nan_to_null(df, columns=None):
    """Map NaN to NULL in floating columns (pandas NaN is a missing value)."""
    floating = (T.DoubleType, T.FloatType)
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, floating)]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def as_double(df, columns=None):
    """Cast decimal columns to double (for display and for engine-neutral comparison)."""
    names = columns or [f.name for f in df.schema.fields
                        if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({n: F.col(n).cast("double") for n in names}) if names else df


def fixed(c, places: int) -> Column:
    """Fixed-decimals text of a decimal (or of a double's shortest form), ties to even as
    Python's `f"{x:.nf}"` rounds a Decimal."""
    exact = _col(c).cast("decimal(38,18)")
    return F.bround(exact, places).cast(f"decimal(38,{places})").cast("string")
