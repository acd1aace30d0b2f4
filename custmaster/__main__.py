"""Command line: run the daily batch.

    python -m custmaster --as-of 2026-12-03 --out /shared/customer_master \
        --tables tables.json          # {"party": "warehouse.party", "policy": "/data/policy", ...}
    python -m custmaster --fixtures /root/testdata/sf0.01 --out /tmp/out   # driver tables

Prints the audit counts (dataset, records, distinct ids) of what was written.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from custmaster.params import FIXTURE_AS_OF, RunParams
from custmaster.plans.batch import run_daily
from custmaster.session import build_session
from custmaster.sources import Sources


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="custmaster")
    ap.add_argument("--out", required=True, help="release folder")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=None,
                    help="business date; required with --tables (fixtures have their own)")
    g = ap.add_mutually_exclusive_group(required=True)
    g.add_argument("--tables", help="JSON file: role -> table name or parquet path")
    g.add_argument("--fixtures", help="folder of the driver's parquet tables")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    ap.add_argument("--concurrent-writes", type=int, default=4)
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="a few times the cluster's cores; enough for the largest shuffle")
    ap.add_argument("--with-address", action="store_true", help="registered addresses, address contacts")
    ap.add_argument("--with-insured", action="store_true", help="the natural persons' insured arm")
    ap.add_argument("--history", default=None, help="folder of the first-creation dates; grows with each run")
    ap.add_argument("--reuse", action="store_true", help="do not write partitions again that did not change")
    ap.add_argument("--keep", type=int, default=2, help="versions that stay readable")
    a = ap.parse_args(argv)
    if a.tables and not a.as_of:
        ap.error("--as-of is required with --tables")

    spark = build_session(a.master, a.shuffle_partitions)
    if a.tables:
        with open(a.tables) as f:
            src = Sources.from_tables(spark, json.load(f))
    else:
        src = Sources.from_fixtures(spark, a.fixtures)
    params = RunParams(as_of=a.as_of or FIXTURE_AS_OF)
    counts = run_daily(spark, src, a.out, params, a.concurrent_writes, a.with_address, a.with_insured,
                       a.history, a.reuse, a.keep)
    for r in counts.collect():
        print(f"{r['dataset']:22s} records={r['records']:>12} distinct_ids={r['distinct_ids']:>12}")


if __name__ == "__main__":
    main()
