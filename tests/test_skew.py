"""Hot keys: one customer with a third of the party history, one contract with
a third of the insured rows.  Results must stay whole and equal to the
brute-force form; AQE skew splitting must not change them."""

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from custmaster.params import FIXTURE_PARAMS
from custmaster.plans import datasets
from custmaster.sources import Sources


@pytest.fixture(scope="module")
def hot(spark, src_small):
    base = src_small
    party = base.party.cache()
    n = party.count()
    # hottest real customer, copied until it holds about a third of all rows
    cust = party.filter("customer_id IS NOT NULL").groupBy("customer_id").count().orderBy(F.desc("count"), "customer_id").first()
    copies = max(1, (n // 2) // cust["count"])
    hot_rows = (party.filter(F.col("customer_id") == cust["customer_id"])
                .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(copies))))
                .withColumn("contract_no", F.col("contract_no") * 100000 + F.col("_k"))
                .drop("_k"))
    hot_party = party.unionByName(hot_rows)
    ins = base.insured
    m = ins.count()
    c = ins.groupBy("contract_no").count().orderBy(F.desc("count"), "contract_no").first()
    hot_ins = ins.unionByName(
        ins.filter(F.col("contract_no") == c["contract_no"])
        .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(max(1, (m // 2) // c["count"])))))
        .withColumn("customer_id", F.col("customer_id") * 1000 + F.col("_k")).drop("_k"))
    loaders = {r: (lambda r=r: getattr(base, r)) for r in
               ("policy", "policy_agent", "benef_health", "benef_travel", "income",
                "entity_manager", "param_lookup", "country_risk", "party_address")}
    loaders["party"] = lambda: hot_party
    loaders["insured"] = lambda: hot_ins
    src = Sources(spark, loaders)
    share = hot_party.filter(F.col("customer_id") == cust["customer_id"]).count() / hot_party.count()
    assert share > 0.3
    return src, cust["customer_id"]


def brute_force_population(spark, src, types):
    src.party.createOrReplaceTempView("bf_party")
    src.policy.createOrReplaceTempView("bf_policy")
    src.insured.createOrReplaceTempView("bf_insured")
    return spark.sql(f"""
        SELECT * FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                       ORDER BY change_date_time DESC, contract_no DESC) AS rn
          FROM bf_party
          WHERE idntfctn_type IN ({types})
            AND customer_id IN (
              SELECT DISTINCT i.customer_id FROM bf_policy p JOIN bf_insured i
                ON p.contract_no = i.contract_no
              WHERE p.policy_status = '7'
                AND (DATE(p.end_datetime) >= DATE'2001-06-01' OR p.end_datetime IS NULL))
        ) WHERE rn = 1""").drop("rn")


def test_population_with_hot_customer(spark, hot):
    src, hot_id = hot
    for cls, types in (("natural", "'1','2','3'"), ("corporate", "'4'")):
        fast = datasets.class_population(src, cls, FIXTURE_PARAMS)
        same_rows(fast, brute_force_population(spark, src, types))
        assert fast.filter(F.col("customer_id") == hot_id).count() <= 1


def test_forced_skew_split_keeps_results(spark, hot):
    src, _ = hot
    base = {n: fn(src, FIXTURE_PARAMS).collect() for n, (_, fn) in datasets.DATASETS.items()
            if n in ("corporate_relations", "natural_relations", "natural_basic")}
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        for n, rows in base.items():
            again = datasets.DATASETS[n][1](src, FIXTURE_PARAMS).collect()
            assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr), n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_aqe_splits_the_hot_contract(spark, hot):
    """With the contract-keyed joins planned as sort-merge joins (as on large
    inputs), AQE marks the joins over the hot contract as skew joins."""
    src, _ = hot
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = datasets.corporate_relations(src, FIXTURE_PARAMS)
        df.collect()
        txt = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in txt
        assert "SortMergeJoin(skew=true)" in txt
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_a_hot_customer_is_spread_over_tasks(spark, hot):
    """The join of the history with the population deals a customer's rows to several
    partitions: none holds the customer alone, also without AQE."""
    from custmaster.operators.population import for_customers
    src, hot_id = hot
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rows = src.party.select("contract_no", "customer_id")
        ids = rows.filter("customer_id IS NOT NULL").select("customer_id").distinct()
        own = for_customers(rows, ids).filter(F.col("customer_id") == hot_id)
        per_task = [r["count"] for r in own.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == rows.filter(F.col("customer_id") == hot_id).count()
        assert len(per_task) >= 4 and max(per_task) < 0.4 * sum(per_task)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
