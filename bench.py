"""Bench: the eight published datasets at one scale factor.

The role tables (party history, policies, ...) are first written as parquet,
untimed: a deployment reads tables, not the fixture adapters.  Then every
dataset, and the natural relations with their insured arm, runs as a full computation (``write.format("noop")`` -- all
rows are produced, nothing is collected to the driver) on
``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1),
then the whole daily batch (populations computed once and checkpointed,
eight datasets written as parquet).  One untimed warm-up pass runs all eight
datasets first; each number is then the best of ``$BENCH_REPEAT`` runs
(default 3).  ``value`` is the sum over the eight datasets.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import partial

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from custmaster.operators.audit import shared_path  # noqa: E402
from custmaster.params import FIXTURE_PARAMS  # noqa: E402
from custmaster.plans import batch, datasets  # noqa: E402
from custmaster.session import build_session, checkpoint_dir  # noqa: E402
from custmaster.sources import Sources  # noqa: E402


def timed(fn, repeat: int) -> float:
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.local.dir": f"{scratch}/local"})
    # the configured spark.checkpoint.dir if any, else a fresh scratch folder
    checkpoint_dir(spark)
    fixtures = Sources.from_fixtures(spark, sf_dir)
    tables = {r: batch.materialise(spark, getattr(fixtures, r), shared_path(spark, f"bench_{r}"))
              for r in fixtures.roles()}
    src = Sources(spark, {r: (lambda d=d: d) for r, d in tables.items()})
    runs = {name: fn for name, (_, fn) in datasets.DATASETS.items()}
    runs["natural_relations_with_insured"] = partial(datasets.natural_relations, with_insured=True)

    def compute(name: str) -> None:
        runs[name](src, FIXTURE_PARAMS).write.format("noop").mode("overwrite").save()

    # warm-up pass (untimed): JIT, parquet footers, codegen caches; and the rows and tasks of a run
    rows, tasks = {}, {}
    tracker = spark.sparkContext.statusTracker()
    for name in runs:
        rows[name] = runs[name](src, FIXTURE_PARAMS).count()
        spark.sparkContext.setJobGroup(name, name)
        compute(name)
        stages = {s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds}
        infos = [i for i in map(tracker.getStageInfo, stages) if i]
        tasks[name] = sum(i.numCompletedTasks for i in infos)

    results: dict[str, float] = {name: timed(lambda name=name: compute(name), repeat) for name in runs}
    number = iter(range(1000))
    results["daily_batch"] = timed(
        lambda: batch.run_daily(spark, src, f"{scratch}/out{next(number)}", FIXTURE_PARAMS).collect(), repeat)

    total = round(sum(results[k] for k in datasets.DATASETS), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "eight_datasets_total", "value": total, "unit": "sec",
                      "queries": results, "rows": rows, "tasks": tasks,
                      "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "repeat": repeat, "warmup": "one pass, untimed", "inputs": "role tables as parquet"}))
    spark.stop()


if __name__ == "__main__":
    main()
