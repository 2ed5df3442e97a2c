"""What the warehouse jobs read and shuffle, counted from Spark's event log."""

import json
import os
import subprocess
import sys

import pytest

from tests.conftest import SF_CHECK

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def rows():
    done = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "rows_read.py"), "--sf", SF_CHECK],
                          capture_output=True, text=True, timeout=400, check=True)
    return json.loads([line for line in done.stdout.splitlines() if line.startswith("{")][-1])


@pytest.mark.parametrize("job", ["transform_sensor", "run_etl"])
def test_raw_readings_are_scanned_at_most_twice(rows, job):
    assert rows["raw_rows"] < rows[f"{job}_raw"] <= 2 * rows["raw_rows"]


def test_fewer_readings_are_shuffled_for_the_pairs(rows):
    assert rows["reconciliation_paired_shuffled"] < 0.5 * rows["reconciliation_all_shuffled"]


@pytest.mark.parametrize("lookup", ["time", "equipment", "equipment_bench", "reading"])
def test_lookups_skip_row_groups_and_pages(rows, lookup):
    assert rows[f"lookup_{lookup}_found"] > 0
    assert rows[f"lookup_{lookup}_read"] < 0.5 * rows["full_scan_read"] == 0.5 * rows["fact_rows"]
