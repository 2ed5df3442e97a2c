"""Print the physical plan of registered queries.

    python tools/explain.py [--sf DIR] [--mode formatted|simple|cost] [--no-broadcast] [name ...]

`--no-broadcast` turns automatic broadcast joins off, which shows the join shapes a
large input would get (explicit, size-checked broadcasts stay).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from orebridge import catalog
    from orebridge.session import build_session
    extra = {}
    if args.no_broadcast:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    for name in args.names or list(catalog.QUERIES):
        print(f"===== {name}")
        catalog.QUERIES[name](spark, args.sf).explain(args.mode)


if __name__ == "__main__":
    main()
