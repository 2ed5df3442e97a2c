import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from orebridge import plans
from orebridge.operators import inject_defects
from orebridge.sources import read_assay_csv, read_table, sensor_base, sensor_raw
from tests.conftest import SF_SMALL

def test_assay_csv_read_and_turnaround(spark, tmp_root):
    # 106/94/98/102 assays of 2/3/4/5 days: mean 3.49, max 5.0
    start = dt.datetime(2025, 1, 15, 6, 1)
    lines = ["assay_id,reading_id,sample_date,result_date,assay_cu_grade"]
    days = [2] * 106 + [3] * 94 + [4] * 98 + [5] * 102
    for i, d in enumerate(days, 1):
        end = start + dt.timedelta(days=d)
        lines.append(f"{i},{1000 + i},{start:%Y-%m-%d %H:%M:%S},{end:%Y-%m-%d %H:%M:%S},0.733")
    path = os.path.join(tmp_root, "assay_results.csv")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    assays = plans.transform_assay(read_assay_csv(spark, path))
    assert assays.count() == 400
    summary = plans.turnaround_summary(assays).first()
    assert round(float(summary.avg_t), 2) == 3.49 and summary.max_t == Decimal("5.0")
    dist = {r.turnaround_days: r["count"] for r in assays.groupBy("turnaround_days").count().collect()}
    assert dist == {Decimal("2.0"): 106, Decimal("3.0"): 94, Decimal("4.0"): 98, Decimal("5.0"): 102}
    assert assays.schema["assay_cu_grade"].dataType.simpleString() == "decimal(6,4)"
    mean = plans.mean_turnaround(assays).first().mean_turnaround_days
    assert round(mean, 2) == 3.49        # unrounded turnarounds are doubles; loading rounds


def test_fixture_defects(spark):
    raw = sensor_raw(spark, SF_SMALL)
    events = read_table(spark, SF_SMALL, "events").count()
    assert raw.select("reading_id").distinct().count() == events
    assert raw.count() > events


def test_inject_defects_rates(spark):
    base = sensor_base(read_table(spark, "/root/testdata/sf0.01", "events"))
    out = inject_defects(base)
    n = base.count()
    assert out.count() == n + n * 3 // 1000
    assert out.where(F.col("tonnage").isNull()).count() >= n // 100
    picked = out.where((F.col("reading_id") + 2) % 200 == 0).select("reading_id", "sensor_cu_grade")
    orig = base.select("reading_id", F.col("sensor_cu_grade").alias("g0"))
    assert picked.join(orig, "reading_id").where("sensor_cu_grade != g0 * 10").count() == 0


def test_sensor_csv_exact_copies_keep_first_line(spark, tmp_root):
    from orebridge.sources import read_sensor_csv
    header = "reading_id,timestamp,equipment_id,bench_id,x_coord,y_coord,sensor_cu_grade,tonnage"
    lines = [header,
             "1,2025-01-01 08:00:00,SHOVEL-01,BENCH-100,1000.00,5000.00,0.8500,100.00",
             "2,2025-01-01 09:00:00,SHOVEL-01,BENCH-105,1000.00,5000.00,0.9000,",
             "1,2025-01-01 08:00:00,SHOVEL-01,BENCH-100,1000.00,5000.00,0.8500,100.00",
             "1,2025-01-01 08:00:00,SHOVEL-01,BENCH-100,1000.00,5000.00,0.8500,120.00"]
    path = os.path.join(tmp_root, "sensor_readings.csv")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = read_sensor_csv(spark, path)
    t = plans.transform_sensor(raw).orderBy("ingest_seq").collect()
    assert [r.is_duplicate for r in t] == [False, False, True, True]
    assert t[1].tonnage == Decimal("100.00")    # median of 100, 100, 120 fills the NULL
    fact = {r.reading_id: r.tonnage for r in plans.sensor_fact(raw).collect()}
    assert fact == {1: Decimal("100.00"), 2: Decimal("100.00")}


def test_csv_header_must_match_schema(spark, tmp_root):
    import pytest
    from orebridge.sources import read_assay_csv
    path = os.path.join(tmp_root, "swapped.csv")
    with open(path, "w") as fh:
        fh.write("reading_id,assay_id,sample_date,result_date,assay_cu_grade\n"
                 "5,1,2025-01-01 00:00:00,2025-01-03 00:00:00,0.5\n")
    with pytest.raises(Exception):
        read_assay_csv(spark, path).collect()


def test_inject_defects_leaves_null_keys_alone(spark):
    from decimal import Decimal as D
    df = spark.createDataFrame([(None, 1, D("0.5000"), D("10.00")), (99, 2, D("0.5000"), D("10.00"))],
                               "reading_id long, ingest_seq long, sensor_cu_grade decimal(6,4), tonnage decimal(8,2)")
    out = inject_defects(df, null_rate=0.5, outlier_rate=0.0, duplicate_rate=0.0)
    row = out.where("reading_id IS NULL").first()
    assert row.tonnage == D("10.00") and out.count() == 2


def test_csv_folder_and_parquet_keep_arrival_order(spark, tmp_root):
    """A small first file and a larger second one share a reading: the first file wins."""
    from orebridge.operators import keep_first
    from orebridge.sources import read_sensor_csv, read_sensor_parquet
    head = "reading_id,timestamp,equipment_id,bench_id,x_coord,y_coord,sensor_cu_grade,tonnage"
    folder = os.path.join(tmp_root, "days.csv")
    os.makedirs(folder)
    row = "{},2025-01-01 00:00:00,E1,BENCH-100,1.0,1.0,0.5,{}"
    for name, lines in (("day1.csv", [row.format(1, 111)]),
                        ("day2.csv", [row.format(1, 222)] + [row.format(i, 50) for i in range(2, 3000)])):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join([head, *lines]) + "\n")
    raw = read_sensor_csv(spark, folder)
    first = keep_first(raw, ["reading_id"], ["ingest_seq"])
    assert first.where("reading_id = 1").first().tonnage == 111
    assert raw.select("ingest_seq").distinct().count() == raw.count() == 3000
    path = os.path.join(tmp_root, "days.parquet")
    raw.orderBy("ingest_seq").drop("ingest_seq").coalesce(1).write.parquet(path)
    again = keep_first(read_sensor_parquet(spark, path), ["reading_id"], ["ingest_seq"])
    assert again.where("reading_id = 1").first().tonnage == 111
