"""Plan report: what the physical plan of every dataset does at scale.

``python -m custmaster.plans.report [sf_dir] > PLANS.md``

The fixture adapters are first written as plain parquet tables (the shape of
a real deployment: one table per source role), and automatic broadcasting is
switched off (as for inputs far above the threshold).  For every dataset the
report counts join strategies and classifies every shuffle by what feeds it: a
partial aggregate or partial window limit (rows combined map-side) or raw
rows.  A join or shuffle that several union arms share is counted once.
"""

from __future__ import annotations

import re
import sys

from custmaster.plans import datasets
from custmaster.operators.audit import shared_path
from custmaster.plans.batch import materialise
from custmaster.params import FIXTURE_PARAMS
from custmaster.session import build_session, checkpoint_dir
from custmaster.sources import Sources


def _node(line: str) -> str:
    m = re.search(r"[+:\- ]*([A-Za-z]+)", line)
    return m.group(1) if m else ""


def _subtree(lines: list[str], i: int) -> str:
    """The plan text under line ``i``, without expression and plan ids."""
    depth = len(lines[i]) - len(lines[i].lstrip(" :|+-"))
    out = [lines[i].lstrip(" :|+-")]
    for line in lines[i + 1:]:
        if len(line) - len(line.lstrip(" :|+-")) <= depth:
            break
        out.append(line.lstrip(" :|+-"))
    return re.sub(r"#\d+L?|plan_id=\d+", "", "\n".join(out))


def summarize(df) -> dict:
    txt = df._jdf.queryExecution().executedPlan().toString()
    lines = txt.splitlines()
    combined = raw = 0
    raw_inputs = []
    seen = set()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line:
            continue
        key = _subtree(lines, i)
        if key in seen:          # the same exchange in another union arm: reused
            continue
        seen.add(key)
        child = _node(lines[i + 1]) if i + 1 < len(lines) else ""
        if child in ("HashAggregate", "ObjectHashAggregate", "SortAggregate",
                     "WindowGroupLimit"):
            combined += 1
        else:
            raw += 1
            keys = re.search(r"hashpartitioning\(([^)]*)\)", line).group(1)
            raw_inputs.append(re.sub(r"#\d+L?", "", keys).rsplit(",", 1)[0])
    joins = {kind: len({_subtree(lines, i) for i, line in enumerate(lines) if kind in line})
             for kind in ("SortMergeJoin", "BroadcastHashJoin")}
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>\n]*>?)", txt)))
    return {
        "shuffles": combined + raw,
        "fed by partial aggregate / limit": combined,
        "of raw rows": raw,
        "sort-merge joins": joins["SortMergeJoin"],
        "broadcast joins": joins["BroadcastHashJoin"],
        "python": len(re.findall("EvalPython|InPandas", txt)),
        "cartesian": len(re.findall("CartesianProduct|BroadcastNestedLoopJoin", txt)),
        "raw_keys": raw_inputs,
        "scans": scans,
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    checkpoint_dir(spark)
    fixtures = Sources.from_fixtures(spark, sf_dir)
    tables = {r: materialise(spark, getattr(fixtures, r), shared_path(spark, r)) for r in fixtures.roles()}
    src = Sources(spark, {r: (lambda d=d: d) for r, d in tables.items()})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    rows = {n: summarize(fn(src, FIXTURE_PARAMS)) for n, (_, fn) in datasets.DATASETS.items()}
    cols = ["shuffles", "fed by partial aggregate / limit", "of raw rows",
            "sort-merge joins", "broadcast joins", "python", "cartesian"]
    print("# Physical plans of the eight datasets\n")
    print("Sources: the fixture adapters of", f"`{sf_dir}`", "written as one parquet table per")
    print("role (the shape of a deployment).  Automatic broadcast off, as for inputs far")
    print("above the threshold.  Plans before adaptive re-planning; a join or an exchange that")
    print("appears in several union arms with the same input is counted once.")
    print("Generated by `python -m custmaster.plans.report`.\n")
    print("| dataset | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for n, r in rows.items():
        print(f"| {n} | " + " | ".join(str(r[c]) for c in cols) + " |")
    print("\n## Shuffles of raw rows (partitioning keys)\n")
    print("Each is the input side of a join (or a union arm) and is needed: its rows")
    print("have no key to combine on before the exchange.\n")
    for n, r in rows.items():
        print(f"* **{n}**: " + "; ".join(f"`{k}`" for k in r["raw_keys"]))
    print("\n## Columns read per scan\n")
    for n, r in rows.items():
        print(f"* **{n}**: " + "; ".join(f"`{c}`" for c in r["scans"]))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
