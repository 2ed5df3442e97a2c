"""Calendar helpers on timestamp_ntz / date columns.

Everything here is independent of the session time zone: dates come from
`to_date` on timestamps without zone, and month starts are built from dates.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orebridge.functions.numeric import _col

# Fixed value: the shift label the time dimension carries.
DEFAULT_SHIFT = "DIA"


def to_date(c) -> Column:
    return F.to_date(_col(c))


def month_start(ts) -> Column:
    """DATE_TRUNC('month', ts) as timestamp_ntz."""
    return F.trunc(F.to_date(_col(ts)), "month").cast("timestamp_ntz")


def add_days(ts, days) -> Column:
    days = F.lit(days) if isinstance(days, int) else _col(days)
    return _col(ts) + F.make_dt_interval(days=days.cast("int"))


MICROSECONDS_PER_DAY = 86_400_000_000


def elapsed_days(start, end) -> Column:
    """(end - start) in days, fractions included, as double. Rounding to a table's NUMERIC
    happens at load."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / F.lit(float(MICROSECONDS_PER_DAY))


def calendar_parts(d) -> dict[str, Column]:
    """Attributes of the time dimension for a date column."""
    d = _col(d)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week": F.weekofyear(d),          # ISO-8601 week
        "day_of_week": F.weekday(d),      # Monday = 0
    }
