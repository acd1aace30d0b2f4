"""The latest-row state day by day; bucketed tables; link rows reduced before they are shuffled."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from custmaster.operators.audit import shared_path
from custmaster.operators.income import contract_pairs
from custmaster.operators.population import populations_by_class
from custmaster.operators.relations import for_contracts
from custmaster.operators.state import CLASS, LatestParty
from custmaster.params import FIXTURE_PARAMS, RunParams
from custmaster.plans import datasets
from custmaster.sources import PARTY_COLUMNS
from custmaster.sources.bucketed import bucket_tables


def test_state_plus_delta_is_the_full_run(spark, src_tables, tmp_path):
    """Three days after a first load; late rows, ties and a day run twice change nothing."""
    party = src_tables.party
    state = LatestParty(spark, str(tmp_path / "s"), datasets.CLASSES, PARTY_COLUMNS)
    days = [dt.datetime(2000, 6, 1), dt.datetime(2000, 9, 1), dt.datetime(2001, 1, 1), dt.datetime(2001, 4, 1)]
    time, seen = F.col("change_date_time"), None
    late = F.pmod(F.xxhash64("contract_no"), F.lit(50)) == 0  # these arrive on the last day
    for n, day in enumerate(days):
        low = F.lit(True) if n == 0 else time >= F.lit(days[n - 1]).cast("timestamp_ntz")
        rows = party.where(low & (time < F.lit(day).cast("timestamp_ntz")) & ~late)
        if n == len(days) - 1:
            rows = rows.unionByName(party.where(late & (time < F.lit(day).cast("timestamp_ntz"))))
        seen = rows if seen is None else seen.unionByName(rows)
        state.add(rows)
        if n == 2:
            state.add(rows)  # a day run twice
        for cls in datasets.CLASSES:
            params = RunParams(as_of=day.date())
            full = populations_by_class(seen.select(*PARTY_COLUMNS), src_tables.policy, src_tables.insured, datasets.CLASSES, params)
            full = full.where(F.col(CLASS) == cls).drop(CLASS)
            same_rows(state.population(cls, src_tables.policy, src_tables.insured, params).select(*full.columns), full)


def test_a_day_that_fails_leaves_the_state(spark, src_tables, tmp_path):
    state = LatestParty(spark, str(tmp_path / "s"), datasets.CLASSES, PARTY_COLUMNS)
    first = state.add(src_tables.party)
    bad = src_tables.party.withColumn("san", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        state.add(bad)
    assert state.release.versions() == [first]


def test_a_day_reads_the_state_and_its_rows(spark, src_tables, tmp_path):
    """The plan of a day ranks state and delta: one row a customer and class besides the day's rows."""
    state = LatestParty(spark, str(tmp_path / "s"), datasets.CLASSES, PARTY_COLUMNS)
    state.add(src_tables.party)
    kept = state.latest().count()
    assert kept == state.latest().select("customer_id", CLASS).distinct().count() < src_tables.party.count()


@pytest.fixture(scope="module")
def bucketed(spark, src_small):
    name = "b" + shared_path(spark, "x")[-10:]
    yield bucket_tables(spark, src_small, name, 8)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_contract_joins_without_exchange(spark, bucketed, src_tables):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def joined(src):
            j = src.insured.join(src.policy, "contract_no").select("contract_no", "customer_id", "policy_status")
            return j, src.policy_agent.join(src.party.select("contract_no", F.col("customer_id").alias("holder")), "contract_no", "left")
        for ours, plain in zip(joined(bucketed), joined(src_tables)):
            assert _exchanges(ours) == [] and len(_exchanges(plain)) == 2
            same_rows(ours, plain)
        # pairs are distinct within a contract's bucket: grouped without a shuffle, too
        assert _exchanges(contract_pairs(bucketed.party)) == []
        for name in ("corporate_relations", "natural_basic"):
            fn = datasets.DATASETS[name][1]
            assert len(_exchanges(fn(bucketed, FIXTURE_PARAMS))) < len(_exchanges(fn(src_tables, FIXTURE_PARAMS))), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", list(datasets.DATASETS))
def test_bucketed_tables_give_the_same_datasets(bucketed, src_small, name):
    fn = datasets.DATASETS[name][1]
    same_rows(fn(bucketed, FIXTURE_PARAMS), fn(src_small, FIXTURE_PARAMS))


def test_link_rows_of_other_contracts_stay_in_their_task(src_tables):
    """The corporate population's contracts are few: the link rows that a join shuffles are, too."""
    pop = datasets.class_population(src_tables, "corporate", FIXTURE_PARAMS)
    contracts = src_tables.party.join(pop.select("customer_id"), "customer_id", "left_semi").select("contract_no").distinct()
    rows = src_tables.policy_agent
    few = for_contracts(rows, contracts)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]
    assert few.count() < 0.7 * rows.count()
    same_rows(few, rows.join(contracts, "contract_no", "left_semi"))
