"""Readers and writers."""

from orebridge.sources.files import (read_assay_csv, read_csv, read_sensor_csv, read_sensor_parquet,
                                     read_table,
                                     with_file_order, write_csv, write_parquet)
from orebridge.sources.fixtures import (assay_raw, sensor_base, sensor_raw,
                                        sensor_raw_from_base)

__all__ = [
    "assay_raw", "read_assay_csv", "read_csv", "read_sensor_csv", "read_sensor_parquet", "read_table", "sensor_base",
    "sensor_raw", "sensor_raw_from_base", "with_file_order", "write_csv", "write_parquet",
]
