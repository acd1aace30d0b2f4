"""Physical-plan shape: the properties the design relies on at scale."""

import re

import pytest

from custmaster.params import FIXTURE_PARAMS
from custmaster.plans import datasets
from custmaster.sources import Sources
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_is_limited_before_the_shuffle(src_tables):
    txt = plan(datasets.class_population(src_tables, "natural", FIXTURE_PARAMS))
    lines = txt.splitlines()
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    final = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Final" in l]
    assert partial and final
    between = lines[final[0]:partial[0]]
    assert any("Exchange hashpartitioning(customer_id" in l for l in between)


def test_membership_join_does_not_undo_the_limit(src_tables):
    # a semi-join would be pushed below the window; the inner join with distinct ids is not
    txt = plan(datasets.class_population(src_tables, "corporate", FIXTURE_PARAMS))
    assert "LeftSemi" not in txt


def test_income_profile_combines_map_side(src_tables):
    txt = plan(datasets.natural_basic(src_tables, FIXTURE_PARAMS))
    assert "partial_collect_set" in txt
    assert "partial_max_by" in txt


@pytest.mark.parametrize("name", list(datasets.DATASETS))
def test_no_python_in_plans(src_tables, name):
    txt = plan(datasets.DATASETS[name][1](src_tables, FIXTURE_PARAMS))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in txt, (name, marker)


def test_scans_are_pruned(src_small, src_tables):
    txt = plan(datasets.natural_risk(src_small, FIXTURE_PARAMS))
    scans = [l for l in txt.splitlines() if "FileScan parquet" in l and "orders" in l]
    assert scans
    for s in scans:
        assert "o_totalprice" not in s and "o_orderpriority" not in s
    # on role tables: the party scan of the risk dataset reads only what it uses
    txt = plan(datasets.natural_risk(src_tables, FIXTURE_PARAMS))
    party_scans = [l for l in txt.splitlines() if "ReadSchema: struct<contract_no:bigint,customer_id:bigint,idntfctn_type" in l]
    assert party_scans
    for s in party_scans:
        assert "customer_name" not in s and "email" not in s and "cellular_phone" not in s


def test_no_job_runs_while_a_dataset_is_built(spark, src_tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    for _, fn in datasets.DATASETS.values():
        fn(src_tables, FIXTURE_PARAMS)
    assert not tracker.getJobIdsForGroup("build-only")


def test_lookups_broadcast_by_size_alone(spark, src_tables):
    assert "BroadcastHashJoin" in plan(datasets.natural_risk(src_tables, FIXTURE_PARAMS))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")     # any table is too large
        txt = plan(datasets.natural_risk(src_tables, FIXTURE_PARAMS))
        assert "BroadcastHashJoin" not in txt and txt.count("SortMergeJoin") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_business_date_reaches_the_scan(spark, src_tables):
    from custmaster.operators.address import on_business_date
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")      # pushed filters in full
        txt = plan(on_business_date(src_tables.party_address, "dbc_business_date", FIXTURE_PARAMS.as_of))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "GreaterThanOrEqual(dbc_business_date" in txt and "LessThan(dbc_business_date" in txt


def test_customer_joins_are_salted_and_history_is_restricted_first(spark, src_tables):
    """The history meets the population on (customer, salt), both sides dealt out for that join,
    and before any distinct."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in ("corporate_relations", "natural_relations", "corporate_basic", "natural_basic"):
            txt = plan(datasets.DATASETS[name][1](src_tables, FIXTURE_PARAMS))
            assert "SortMergeJoin [customer_id" in txt, name
            salted = [x for x in txt.splitlines() if "SortMergeJoin [customer_id" in x and "_salt" in x]
            assert salted, name
            assert txt.count("Exchange hashpartitioning(customer_id") >= 2
        # four pruned scans of the party history: pairs, managers, persons, ids of the class
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        txt = plan(datasets.corporate_relations(src_tables, FIXTURE_PARAMS))
        scans = {re.sub(r"#\d+L?|^[\s:+|*()\d-]*", "", x) for x in txt.splitlines()
                 if "FileScan parquet" in x and "fixture_party-" in x}
        assert 0 < len(scans) <= 4, scans
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_reach_the_scan_of_a_real_table(spark, tmp_path):
    # production shape: the policy table is a parquet table, not an adapter
    path = str(tmp_path / "policy")
    Sources.from_fixtures(spark, SF_SMALL).policy.write.parquet(path)
    src = Sources.from_tables(spark, {"policy": path})
    from custmaster.operators.population import policies_in_force
    txt = plan(policies_in_force(src.policy, FIXTURE_PARAMS))
    assert "PushedFilters: [IsNotNull(policy_status), EqualTo(policy_status,7)" in txt \
        or "EqualTo(policy_status,7)" in txt
    assert "ReadSchema: struct<contract_no:bigint,policy_status:string,end_datetime" in txt
