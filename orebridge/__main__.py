"""Command line: the two jobs a user runs.

    python -m orebridge etl    --sensor S.csv --assay A.csv --warehouse DIR [--append]
                               [--processed DIR] [--counters]
    python -m orebridge report --warehouse DIR [--sla-days 5]

`etl` reads the raw CSV files (or Parquet folders, by extension), cleans and
flags the sensor rows, builds the dimensions and loads the five tables; by default
all tables are replaced (full refresh). `report` prints the four quality checks and
the run summary from the stored tables. Spark settings come from spark-submit /
spark-defaults as usual; `--master` is only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys
import time


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="orebridge")
    ap.add_argument("--master", default=None,
                    help="Spark master for local runs (spark-submit sets it otherwise)")
    ap.add_argument("--buckets", type=int, default=None,
                    help="bucket both facts by reading_id for shuffle-free joins")
    ap.add_argument("--database", default=None,
                    help="catalog database of the tables and views (default: named after the warehouse folder)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    etl = sub.add_parser("etl")
    etl.add_argument("--sensor", required=True, help="raw sensor readings: .csv file/folder or Parquet")
    etl.add_argument("--assay", required=True, help="raw assay results: .csv file/folder or Parquet")
    etl.add_argument("--warehouse", required=True, help="root folder of the five tables (shared storage)")
    etl.add_argument("--append", action="store_true",
                     help="insert new dimension members and append checked facts")
    etl.add_argument("--processed", default=None,
                     help="also write the cleaned sets as CSV: DIR/sensor_readings_clean "
                          "(every row, with flags) and DIR/assay_results_clean (with turnaround)")
    etl.add_argument("--counters", action="store_true",
                     help="print the QC run counters and outlier bounds")
    rep = sub.add_parser("report")
    rep.add_argument("--warehouse", required=True, help="root folder of the five tables")
    rep.add_argument("--sla-days", type=int, default=None,
                     help="turnaround (days) above which an assay violates the lab SLA")
    args = ap.parse_args(argv)

    from orebridge import plans
    from orebridge.plans.warehouse import Warehouse
    from orebridge.session import build_session
    spark = build_session(args.master)
    wh = Warehouse(spark, args.warehouse, buckets=args.buckets, database=args.database)

    if args.cmd == "etl":
        start = time.perf_counter()
        sensor, assay = plans.extract(spark, args.sensor, args.assay)
        from orebridge.session import size_shuffle_partitions
        size_shuffle_partitions(spark, sensor, assay)
        stats = plans.raw_statistics(sensor, repeated=True)      # once for all steps
        if args.processed:
            from orebridge.sources import write_csv
            out = args.processed.rstrip("/")
            write_csv(plans.transform_sensor(sensor, stats=stats), f"{out}/sensor_readings_clean")
            write_csv(plans.transform_assay(assay), f"{out}/assay_results_clean")
        if args.counters:
            counters = plans.qc_counters(sensor, stats).first().asDict()
            bounds = stats.bounds().first().asDict()
            print(json.dumps({**counters, **{k: bounds[k] for k in ("lower_limit", "upper_limit")}}))
        counts = plans.run_etl(sensor, assay, wh, refresh=not args.append, stats=stats)
        counts["elapsed_seconds"] = round(time.perf_counter() - start, 2)
        print(json.dumps(counts))
        return 0

    plans.show_report(plans.warehouse_report(wh))
    sensor, assay = wh.table("fact_sensor_readings"), wh.table("fact_assay_results")
    kwargs = {"sla_days": args.sla_days} if args.sla_days is not None else {}
    plans.run_summary(sensor, assay, **kwargs).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
