"""Column helpers built only from `pyspark.sql.functions` (JVM-side, codegen'd)."""

from orebridge.functions.dates import (add_days, calendar_parts, elapsed_days,
                                       month_start, to_date)
from orebridge.functions.grades import (accuracy_category, calibration_status,
                                        grade_difference, relative_error_pct)
from orebridge.functions.numeric import (as_double, exact_mean, fixed, nan_to_null,
                                         non_negative, round_half_up)

__all__ = [
    "accuracy_category", "add_days", "as_double", "calendar_parts", "calibration_status",
    "elapsed_days", "exact_mean", "fixed", "grade_difference", "month_start",
    "nan_to_null", "non_negative", "relative_error_pct", "round_half_up", "to_date",
]
