"""transform_sensor against a plain-Python model of the transform, on skewed data."""

import math
import random
import statistics
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from orebridge import plans

SCHEMA = ("ingest_seq long, reading_id long, timestamp timestamp_ntz, equipment_id string, "
          "bench_id string, x_coord decimal(10,2), y_coord decimal(10,2), "
          "sensor_cu_grade decimal(6,4), tonnage decimal(8,2)")


def make_rows(seed: int):
    rnd = random.Random(seed)
    rows, seq = [], 0
    for i in range(400):
        rid = 7 if i % 13 == 0 else i                         # one reading with ~30 copies
        eq = rnd.choices(["hot", "b", "allnull", None], [70, 20, 5, 5])[0]
        grade = None if rnd.random() < 0.03 else Decimal(rnd.randint(1000, 9000)).scaleb(-4)
        if grade is not None and rnd.random() < 0.02:
            grade = grade * 10                                 # sensor gone wild
        tons = None if (eq == "allnull" or rnd.random() < 0.1) else Decimal(rnd.randint(8000, 25000)).scaleb(-2)
        seq += rnd.randint(1, 5)
        rows.append((seq, rid, datetime(2025, 1, 1) + timedelta(minutes=i), eq, "BENCH-100",
                     Decimal("1.00"), Decimal("2.00"), grade, tons))
    rnd.shuffle(rows)                                          # arrival order is ingest_seq, not list order
    return rows


def model(rows):
    """The transform's rules, row by row: first occurrence by ingest_seq; tonnage median
    per non-NULL equipment over all rows; mean +- 3 sample std of the grade (lower
    limit floored at 0, strict comparisons, NULL grade never an outlier)."""
    ordered = sorted(rows, key=lambda r: r[0])
    seen, dup = set(), {}
    for r in ordered:
        dup[r[0]] = r[1] in seen
        seen.add(r[1])
    by_eq = {}
    for r in rows:
        if r[3] is not None and r[8] is not None:
            by_eq.setdefault(r[3], []).append(r[8])
    med = {e: Decimal(statistics.median(v)).quantize(Decimal("0.01"), ROUND_HALF_UP) for e, v in by_eq.items()}
    grades = [float(r[7]) for r in rows if r[7] is not None]
    mean = statistics.fmean(grades)
    std = statistics.stdev(grades) if len(grades) > 1 else math.nan
    upper, lower = mean + 3 * std, max(0.0, mean - 3 * std)
    out = {}
    for r in rows:
        tons = None if r[3] is None else (r[8] if r[8] is not None else med.get(r[3]))
        g = None if r[7] is None else float(r[7])
        outlier = g is not None and (g > upper or g < lower)
        out[r[0]] = (dup[r[0]], tons, outlier, (not dup[r[0]]) and not outlier and tons is not None)
    return out, (lower, upper)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_transform_matches_model(spark, seed):
    rows = make_rows(seed)
    want, (lower, upper) = model(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.ingest_seq: (r.is_duplicate, r.tonnage, r.is_outlier, r.qc_passed)
           for r in plans.transform_sensor(df).collect()}
    assert got.keys() == want.keys()
    near = {r[0] for r in rows if r[7] is not None
            and min(abs(float(r[7]) - upper), abs(float(r[7]) - lower)) < 1e-9}
    for seq, expected in want.items():
        if seq not in near:
            assert got[seq] == expected, (seq, got[seq], expected)
    fact = plans.sensor_fact(df)
    assert fact.count() == len({r[1] for r in rows})
