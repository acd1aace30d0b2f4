"""The daily batch: all eight datasets for one business date.

The populations of both classes are ranked in one pass over the party
history and written as one parquet table, partitioned by class, into the
cluster's shared checkpoint folder (``spark.checkpoint.dir``); four datasets
per class read it back.  That cuts the lineage (a lost executor costs a
re-read of those files, not a re-run of the ranking over the whole party
history), keeps file statistics for the planner, and lets each dataset read
only the population columns it uses -- measured faster than an RDD
``checkpoint()``, whose rows carry no statistics.

The tables derived from the party history that several datasets share are made from
the rows of the population's customers only (contract-customer pairs, contact rows), or
of the persons that the link tables name (person lookup), written the same way, all at
once.  All of these tables live in one folder of the run, which is removed when the
run ends, failed or not.

The datasets are written as one version of a release (``operators.release``): they
become visible together when all are there, and counted while they are written.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custmaster.operators.audit import remove, shared_path
from custmaster.operators.contacts import party_contact_rows
from custmaster.operators.history import History
from custmaster.operators.income import contract_pairs
from custmaster.operators.population import for_customers, populations_by_class
from custmaster.operators.relations import for_contracts, person_lookup
from custmaster.operators.release import Release
from custmaster.params import RunParams
from custmaster.plans.datasets import CLASSES, DATASETS
from custmaster.sources import PARTY_COLUMNS, Sources


def materialise(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet at ``path`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def populations(spark: SparkSession, src: Sources, params: RunParams, folder: str) -> dict[str, DataFrame]:
    """Both classes' populations, ranked in one pass over the party history, written once
    partitioned by class below ``folder``, and read back per class (partition pruning)."""
    party = src.party.select(*PARTY_COLUMNS)
    both = populations_by_class(party, src.policy, src.insured, CLASSES, params)
    path = f"{folder}/population"
    both.write.mode("overwrite").partitionBy("_class").parquet(path)
    return {cls: spark.read.parquet(path).filter(F.col("_class") == cls).drop("_class")
            for cls in CLASSES}


def shared_party_tables(spark: SparkSession, src: Sources, folder: str, members: DataFrame) -> Sources:
    """Materialise the tables derived from the party history that several datasets use (pairs: 4
    datasets, persons: 2, contacts: 2), restricted to ``members`` (customer_id, once each) and to
    the persons that a dataset can ask for: each is one scan of the history instead of one per
    dataset, and the history's rows of nobody's interest end at that scan's join."""
    links = ("policy_agent", "insured", "benef_health", "benef_travel", "income", "income_extra", "product_risk")
    asked = src.insured.select("customer_id").unionByName(
        src.benef_health.select(F.col("assured_id").alias("customer_id"))).where("customer_id IS NOT NULL").distinct()
    own = for_customers(src.party.select("contract_no", "customer_id"), members)
    reach = for_customers(src.party.select("contract_no", "customer_id", "cellular_phone", "email"), members)
    known = for_customers(src.party.select("contract_no", "customer_id", "birthday", "national_country_code"), asked)
    tables = {
        "pairs": contract_pairs(own),
        "persons": person_lookup(known),
        "contacts": party_contact_rows(reach).distinct(),
    }
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        made = {k: pool.submit(materialise, spark, v, f"{folder}/party_{k}") for k, v in tables.items()}
        derived = {k: f.result() for k, f in made.items()}
    # link rows of other contracts reach no dataset: every arm is inner on the pairs
    contracts = materialise(spark, derived["pairs"].select("contract_no").distinct(), f"{folder}/contracts")
    return src.mapped(links, lambda rows: for_contracts(rows, contracts)).with_derived(derived)


def builders(with_address: bool = False, with_insured: bool = False) -> dict[str, tuple[str, Callable]]:
    """The datasets' builders: registered addresses and address contacts, and the
    natural persons' insured arm, are on request as in the source."""
    out = dict(DATASETS)
    if with_address:
        for name in ("corporate_basic", "natural_basic", "corporate_contact", "natural_contact"):
            out[name] = (out[name][0], partial(out[name][1], with_address=True))
    if with_insured:
        cls, fn = out["natural_relations"]
        out["natural_relations"] = (cls, partial(fn, with_insured=True))
    return out


def run_daily(spark: SparkSession, src: Sources, out_dir: str, params: RunParams,
              concurrent_writes: int = 4, with_address: bool = False, with_insured: bool = False,
              history: str | None = None, reuse: bool = False, keep: int = 2) -> DataFrame:
    """Publish every dataset as the next version of the release ``out_dir`` and return the audit
    counts (taken while the datasets were written; ``Release.counts(exact=True)`` reads them).

    The eight writes are independent Spark jobs; up to ``concurrent_writes``
    are submitted at once so that the tail stages of one dataset do not leave
    the cluster idle.  A run that fails anywhere leaves the version before as it is.

    ``history`` keeps when each id was first published, per dataset (``operators.history``):
    CREATE_DATE is that date, also for ids that were absent in between.  It grows after
    the version is committed.  ``reuse``: partitions that did not change are not written again.
    """
    release = Release(spark, out_dir, keep)
    folder = shared_path(spark, f"run_{params.as_of:%Y%m%d}")
    try:
        pops = populations(spark, src, params, folder)
        members = pops["corporate"].select("customer_id").unionByName(pops["natural"].select("customer_id")).distinct()
        shared = shared_party_tables(spark, src, folder, members)
        built = {name: fn(shared, params, pop=pops[cls])
                 for name, (cls, fn) in builders(with_address, with_insured).items()}
        first = {name: History(spark, f"{history.rstrip('/')}/{name}") for name in built} if history else {}
        for name, known in first.items():
            built[name] = known.with_first_created(built[name])
        run = release.begin()
        with ThreadPoolExecutor(max_workers=max(1, concurrent_writes)) as pool:
            for f in [pool.submit(run.write, name, df, reuse=reuse) for name, df in built.items()]:
                f.result()
        run.commit()
    finally:
        remove(spark, folder)
    for name, known in first.items():
        known.add_segment(release.read(name, run.number))
    return release.counts()
