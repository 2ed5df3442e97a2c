import json
import os

from orebridge.__main__ import main
from orebridge.sources import assay_raw, sensor_raw, write_csv
from tests.conftest import SF_SMALL


def test_etl_and_report_from_csv(spark, tmp_root, capsys):
    # raw inputs as CSV without an arrival column, as the reference's files are
    write_csv(sensor_raw(spark, SF_SMALL).drop("ingest_seq").coalesce(1), f"{tmp_root}/sensor.csv")
    write_csv(assay_raw(spark, SF_SMALL).coalesce(1), f"{tmp_root}/assay.csv")
    wh = f"{tmp_root}/wh"
    assert main(["etl", "--sensor", f"{tmp_root}/sensor.csv", "--assay", f"{tmp_root}/assay.csv",
                 "--warehouse", wh, "--processed", f"{tmp_root}/processed", "--counters"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    counters, loaded = lines[0], lines[1]
    assert counters["duplicates"] > 0 and counters["null_tonnage"] > 0
    assert counters["qc_passed"] <= counters["total_rows"] - counters["duplicates"]
    assert counters["lower_limit"] == 0.0 and counters["upper_limit"] > 0
    assert loaded["fact_sensor_readings"] == counters["total_rows"] - counters["duplicates"]
    assert os.path.isdir(f"{tmp_root}/processed/sensor_readings_clean")
    assert os.path.isdir(f"{tmp_root}/processed/assay_results_clean")
    assert main(["report", "--warehouse", wh, "--sla-days", "4"]) == 0
    out = capsys.readouterr().out
    assert "== equipment_kpis" in out and "Equipo " in out and "Turnaround promedio" in out
