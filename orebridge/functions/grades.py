"""Sensor-versus-assay comparison expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from orebridge.functions.numeric import _col, round_half_up

# The error bands of the reconciliation view, checked in this order
# with `<=` on the absolute grade difference; anything else (NULL too) is the last label.
ACCURACY_BANDS = [
    (Decimal("0.05"), "EXCELENTE"),
    (Decimal("0.10"), "ACEPTABLE"),
    (Decimal("0.20"), "REVISAR"),
]
ACCURACY_OTHERWISE = "CRITICO"

# Calibration check on the signed mean error.
CALIBRATION_LIMIT = Decimal("0.05")
CALIBRATION_OK = "OK"
CALIBRATION_FAIL = "REVISAR CALIBRACIÓN"


def grade_difference(sensor="sensor_cu_grade", assay="assay_cu_grade") -> Column:
    """Signed difference sensor - assay, 4 places."""
    return round_half_up(_col(sensor) - _col(assay), 4)


def relative_error_pct(sensor="sensor_cu_grade", assay="assay_cu_grade") -> Column:
    """(sensor - assay) / assay * 100, 2 places; NULL when the assay is 0."""
    s, a = _col(sensor), _col(assay)
    return round_half_up((s - a) / F.nullif(a, F.lit(Decimal("0"))) * 100, 2)


def accuracy_category(sensor="sensor_cu_grade", assay="assay_cu_grade") -> Column:
    diff = F.abs(_col(sensor) - _col(assay))
    expr = None
    for limit, label in ACCURACY_BANDS:
        cond = diff <= F.lit(limit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(ACCURACY_OTHERWISE)


def calibration_status(bias="bias") -> Column:
    return F.when(F.abs(_col(bias)) <= F.lit(CALIBRATION_LIMIT), CALIBRATION_OK) \
        .otherwise(CALIBRATION_FAIL)
