"""Typed schemas: the raw inputs and the five star-schema tables.

Types follow the reference DDL: VARCHAR -> string, NUMERIC(p,s) -> decimal(p,s),
TIMESTAMP without zone -> timestamp_ntz, SERIAL -> bigint surrogate key.
"""

from pyspark.sql import types as T

GRADE = T.DecimalType(6, 4)       # % Cu
TONNAGE = T.DecimalType(8, 2)     # tonnage, capacity
COORD = T.DecimalType(10, 2)
TURNAROUND = T.DecimalType(4, 1)  # days
TS = T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Raw sensor input. `ingest_seq` is the arrival order that "first" refers to.
SENSOR_RAW = _schema(
    ("ingest_seq", T.LongType(), True),
    ("reading_id", T.LongType(), True),
    ("timestamp", TS, True),
    ("equipment_id", T.StringType(), True),
    ("bench_id", T.StringType(), True),
    ("x_coord", COORD, True),
    ("y_coord", COORD, True),
    ("sensor_cu_grade", GRADE, True),
    ("tonnage", TONNAGE, True),
)

# The CSV the reference writes has no sequence column; row order is the file order.
SENSOR_CSV = _schema(*[(f.name, f.dataType, True) for f in SENSOR_RAW.fields
                       if f.name != "ingest_seq"])

ASSAY_RAW = _schema(
    ("assay_id", T.LongType(), True),
    ("reading_id", T.LongType(), True),
    ("sample_date", TS, True),
    ("result_date", TS, True),
    ("assay_cu_grade", GRADE, True),
)

DIM_EQUIPMENT = _schema(
    ("equipment_id", T.StringType(), False),
    ("equipment_type", T.StringType(), False),
    ("model", T.StringType(), True),
    ("capacity_tons", TONNAGE, True),
    ("active", T.BooleanType(), True),
    ("created_at", TS, True),
)

DIM_LOCATION = _schema(
    ("location_id", T.LongType(), False),
    ("bench_id", T.StringType(), False),
    ("bench_elevation", T.IntegerType(), True),
    ("zone", T.StringType(), True),
    ("created_at", TS, True),
)

DIM_TIME = _schema(
    ("time_id", T.LongType(), False),
    ("full_date", T.DateType(), False),
    ("year", T.IntegerType(), False),
    ("quarter", T.IntegerType(), False),
    ("month", T.IntegerType(), False),
    ("month_name", T.StringType(), False),
    ("week", T.IntegerType(), False),
    ("day_of_week", T.IntegerType(), False),
    ("shift", T.StringType(), True),
)

FACT_SENSOR = _schema(
    ("reading_id", T.LongType(), False),
    ("timestamp", TS, False),
    ("equipment_id", T.StringType(), True),
    ("bench_id", T.StringType(), True),
    ("x_coord", COORD, True),
    ("y_coord", COORD, True),
    ("sensor_cu_grade", GRADE, True),
    ("tonnage", TONNAGE, True),
    ("is_outlier", T.BooleanType(), True),
    ("is_duplicate", T.BooleanType(), True),
    ("qc_passed", T.BooleanType(), True),
    ("loaded_at", TS, True),
)

FACT_ASSAY = _schema(
    ("assay_id", T.LongType(), False),
    ("reading_id", T.LongType(), True),
    ("sample_date", TS, False),
    ("result_date", TS, False),
    ("assay_cu_grade", GRADE, True),
    ("turnaround_days", TURNAROUND, True),
    ("loaded_at", TS, True),
)

TABLES = {
    "dim_equipment": DIM_EQUIPMENT,
    "dim_location": DIM_LOCATION,
    "dim_time": DIM_TIME,
    "fact_sensor_readings": FACT_SENSOR,
    "fact_assay_results": FACT_ASSAY,
}

# Business keys of each table (primary key or UNIQUE column).
TABLE_KEYS = {
    "dim_equipment": ["equipment_id"],
    "dim_location": ["bench_id"],
    "dim_time": ["full_date"],
    "fact_sensor_readings": ["reading_id"],
    "fact_assay_results": ["assay_id"],
}

# Columns the DDL declares NOT NULL, besides the keys.
TABLE_NOT_NULL = {
    "dim_equipment": ["equipment_type"],
    "dim_location": [],
    "dim_time": ["year", "quarter", "month", "month_name", "week", "day_of_week"],
    "fact_sensor_readings": ["timestamp"],
    "fact_assay_results": ["sample_date", "result_date"],
}

# VARCHAR(n) limits of the declared tables.
TABLE_VARCHAR = {
    "dim_equipment": {"equipment_id": 20, "equipment_type": 50, "model": 50},
    "dim_location": {"bench_id": 20, "zone": 20},
    "dim_time": {"month_name": 20, "shift": 10},
    "fact_sensor_readings": {"equipment_id": 20, "bench_id": 20},
    "fact_assay_results": {},
}

# Column defaults applied on insert when the incoming rows lack the column.
TABLE_DEFAULTS = {
    "dim_equipment": {"active": True},
    "fact_sensor_readings": {"is_outlier": False, "is_duplicate": False, "qc_passed": None},
}

SENSOR_FACT_COLUMNS = [f.name for f in FACT_SENSOR.fields if f.name != "loaded_at"]
ASSAY_FACT_COLUMNS = [f.name for f in FACT_ASSAY.fields if f.name != "loaded_at"]
