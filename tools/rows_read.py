"""Rows read and shuffled by the warehouse jobs over written inputs, from Spark's event log.

    python tools/rows_read.py [--sf DIR]      # prints one JSON object

Raw sensor and assay rows are written as Parquet first, so the fixture's own predicates reach
no scan. Each step runs under its own job group; the event log goes to a fresh scratch folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Small row groups and pages, so that a test-sized table has several to skip.
SMALL_PAGES = {"parquet.block.size": "16384", "parquet.page.size": "2048", "parquet.page.row.count.limit": "100"}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    work = tempfile.mkdtemp(prefix="orebridge-rows-")
    log_dir = os.path.join(work, "events")
    os.mkdir(log_dir)
    from orebridge import plans
    from orebridge.plans.warehouse import Warehouse
    from orebridge.session import build_session
    from orebridge.sources import assay_raw, sensor_raw
    spark = build_session("local[4]", shuffle_partitions=4, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.warehouse.dir": os.path.join(work, "spark"), "spark.checkpoint.dir": os.path.join(work, "ckpt")})
    sensor_raw(spark, args.sf).write.parquet(f"{work}/sensor")
    assay_raw(spark, args.sf).write.parquet(f"{work}/assay")
    raw, raw_assay = spark.read.parquet(f"{work}/sensor"), spark.read.parquet(f"{work}/assay")
    assay = plans.assay_fact(raw_assay)
    out = {"raw_rows": raw.count(), "assay_rows": raw_assay.count()}

    def step(name, run):
        spark.sparkContext.setJobGroup(name, name)
        run()
        spark.sparkContext.setJobGroup("other", "other")

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    step("transform_sensor", lambda: drain(plans.transform_sensor(raw)))
    wh = Warehouse(spark, f"{work}/wh", write_options=SMALL_PAGES)
    wh.create()
    step("run_etl", lambda: plans.run_etl(raw, raw_assay, wh))
    step("reconciliation_all", lambda: drain(plans.reconciliation(plans.sensor_fact(raw), assay)))
    step("reconciliation_paired", lambda: drain(plans.reconciliation(plans.paired_sensor_fact(raw, assay), assay)))
    fact = wh.table("fact_sensor_readings")
    out["fact_rows"] = fact.count()
    day = wh.rows_between("fact_sensor_readings", dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21))
    out["lookup_time_found"] = day.count()
    step("lookup_time", lambda: drain(day))
    for name, cond in {
            "lookup_equipment": "equipment_id = 'signup'",
            "lookup_equipment_bench": "equipment_id = 'signup' AND bench_id = 'BENCH-105'",
            "lookup_reading": "reading_id = 77"}.items():
        out[f"{name}_found"] = fact.where(cond).count()
        step(name, lambda c=cond: drain(fact.where(c)))
    step("full_scan", lambda: drain(fact.where("sensor_cu_grade IS NOT NULL")))
    spark.stop()

    groups, totals = {}, defaultdict(lambda: defaultdict(int))
    of_raw = set()                                   # row counters of scans of the raw readings

    def scans(node):
        if node["nodeName"].startswith("Scan") and f"{work}/sensor" in node.get("metadata", {}).get("Location", ""):
            of_raw.update(m["accumulatorId"] for m in node["metrics"] if m["name"] == "number of output rows")
        for child in node["children"]:
            scans(child)
    for path in sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)):
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if "sparkPlanInfo" in ev:
                    scans(ev["sparkPlanInfo"])
                if ev.get("Event") == "SparkListenerJobStart":
                    for sid in ev.get("Stage IDs", []):
                        groups[sid] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                elif ev.get("Event") == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
                    t, m = totals[groups.get(ev["Stage ID"])], ev["Task Metrics"]
                    t["read"] += m["Input Metrics"]["Records Read"]
                    t["shuffled"] += m["Shuffle Write Metrics"]["Shuffle Records Written"]
                    t["raw"] += sum(int(a["Update"]) for a in ev["Task Info"]["Accumulables"]
                                    if a["ID"] in of_raw and "Update" in a)
    for name, t in totals.items():
        if name and name != "other":
            out[f"{name}_read"], out[f"{name}_shuffled"], out[f"{name}_raw"] = t["read"], t["shuffled"], t["raw"]
    print(json.dumps(out))


if __name__ == "__main__":
    main()
