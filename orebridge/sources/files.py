"""File sources and sinks.

CSV inputs are read with an explicit schema (never inferred) in FAILFAST mode, so a
malformed line stops the job instead of turning into NULLs. Parquet is the format
for everything the library writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orebridge import schemas
from orebridge.functions.numeric import nan_to_null


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_file_order(df: DataFrame, file_col: str = "ingest_file",
                    row_col: str = "ingest_row") -> DataFrame:
    """Add the arrival order of each row of a Parquet scan: (file path, row index).

    This is the order "first occurrence" refers to; it is stable across reruns.
    """
    return df.withColumns({file_col: F.col("_metadata.file_path"),
                           row_col: F.col("_metadata.row_index")})


# Timestamps as the reference's CSV files hold them; fractions are optional on read
# and written to the microsecond so a round trip is lossless.
TS_READ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TS_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with header, an explicit schema and FAILFAST parsing. The header must name
    the schema's columns in order (checked), so a reordered file cannot be misread."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", TS_READ_FORMAT)
            .csv(path))


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sensor readings CSV (header, parsed timestamp).

    "First occurrence" means arrival order: files by path, lines by position. If the files
    have no `ingest_seq` column, rows are numbered in the order (file, byte offset of the
    split, position in the split). The position comes from one materialised scan (a row's
    number is fixed there), so later scans and re-run tasks agree on it.
    """
    header = spark.read.option("header", True).csv(path).columns
    schema = schemas.SENSOR_RAW if "ingest_seq" in header else schemas.SENSOR_CSV
    df = read_csv(spark, path, schema)
    if "ingest_seq" not in df.columns:
        df = _numbered(df.withColumns({
            "__file": F.col("_metadata.file_path"), "__split": F.col("_metadata.file_block_start"),
            "__row": F.monotonically_increasing_id()}), ["__file", "__split", "__row"])
    return nan_to_null(df.select(*schemas.SENSOR_RAW.fieldNames()))


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` materialised once, with ingest_seq = 1, 2, ... in `order`, which is dropped."""
    from orebridge.operators.keys import assign_surrogate_keys
    from orebridge.session import reliable_checkpoint
    return assign_surrogate_keys(reliable_checkpoint(df), "ingest_seq", order, materialized=True).drop(*order)


def read_sensor_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Sensor readings from Parquet; without `ingest_seq` they are numbered by file and row."""
    df = spark.read.parquet(path)
    if "ingest_seq" not in df.columns:
        df = _numbered(with_file_order(df, "__file", "__row"), ["__file", "__row"])
    return df.select(*schemas.SENSOR_RAW.fieldNames())


def read_assay_csv(spark: SparkSession, path: str) -> DataFrame:
    """Assay results CSV (header, two parsed timestamps)."""
    return read_csv(spark, path, schemas.ASSAY_RAW)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with header; one folder of part files (distributed write)."""
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", TS_WRITE_FORMAT).csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
