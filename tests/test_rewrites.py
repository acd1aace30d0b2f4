"""Naive (source) forms against the rewritten forms used by the datasets, and
result stability under different shuffle partition counts."""

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from custmaster.params import FIXTURE_PARAMS
from custmaster.functions import codes
from custmaster.functions.columns import null_text, text
from custmaster.operators import income, relations
from custmaster.operators.contacts import distinct_contacts
from custmaster.plans import datasets


def test_bridge_rewrite_insured_arm(src_small):
    """R1 + R2: insured arm over bridge + population == naive history joins + final join."""
    src = src_small
    pop = datasets.class_population(src, "corporate", FIXTURE_PARAMS)
    # naive: insured ⟕ party(contract) ⟕ party(person), distinct, ⋈ population
    p1 = src.party.select("contract_no", F.col("customer_id").alias("cid"))
    p2 = src.party.select(F.col("customer_id").alias("nid"), "national_country_code")
    naive = (src.insured.join(p1, "contract_no", "left")
             .join(p2, F.col("customer_id") == F.col("nid"), "left")
             .select(F.col("cid").alias("customer_id"),
                     text("customer_name").alias("C_FULLNAME"),
                     text("birthday").alias("BIRTHDAY_DATE"),
                     text(F.col("customer_id")).alias("RELATION_ID_NO"),
                     text("national_country_code").alias("COUNTRY")).distinct()
             .join(pop.select("customer_id"), "customer_id"))
    bridge = income.contract_customer_bridge(src.party, pop.select("customer_id"))
    nat = relations.person_bridge(src.party, ["national_country_code"])
    fast = relations.insured_rows(src.insured, bridge, nat).select(*naive.columns)
    assert naive.count() > 0
    same_rows(naive, fast)


def test_twin_arms_rewrite(src_small):
    """R5: manager arm once + explode == two separate arms."""
    src = src_small
    em = src.entity_manager.select("idntfctn_type", "customer_id",
                                   F.col("manager_name").alias("en"),
                                   F.col("birthday").alias("eb"),
                                   F.col("national_country_code").alias("ec"))
    j = src.party.join(em, ["idntfctn_type", "customer_id"], "left")

    def arm(tag):
        return j.select(F.col("customer_id"), F.lit(tag).cast("int").alias("RELATION_TYPE"),
                        text(F.coalesce("en", "manager_name")).alias("C_FULLNAME"),
                        text(codes.job_title(F.col("risk_jobtitle_code"))).alias("REPRESNT_POS"),
                        null_text().alias("RELATION_CODE"), text("eb").alias("BIRTHDAY_DATE"),
                        text("manager_id").alias("RELATION_ID_NO"),
                        text("ec").alias("COUNTRY")).distinct()
    naive = arm(2).unionByName(arm(3))
    fast = relations.manager_rows(src.party, src.entity_manager).select(*naive.columns)
    same_rows(naive, fast)


def test_contacts_one_scan_rewrite(src_small):
    """R4: explode-based contacts == union of two filtered scans."""
    p = src_small.party
    a = p.filter((F.col("cellular_phone") != "") & F.col("cellular_phone").isNotNull()).select(
        F.col("customer_id").alias("ID"), F.lit("5").alias("CONTACT_TYPE"),
        F.col("cellular_phone").alias("CONTENT"))
    b = p.filter((F.col("email") != "") & F.col("email").isNotNull()).select(
        F.col("customer_id").alias("ID"), F.lit("6").alias("CONTACT_TYPE"),
        F.col("email").alias("CONTENT"))
    same_rows(a.unionByName(b).distinct(), distinct_contacts(p))


def test_income_bridge_rewrite(src_small):
    """R1 for the income profile: bridge == full history join."""
    src = src_small
    hist = src.party.select("contract_no", "customer_id").filter("customer_id IS NOT NULL")
    a = income.income_profile(src.income, hist)
    b = income.income_profile(src.income, income.contract_customer_bridge(src.party))
    same_rows(a, b)


@pytest.mark.parametrize("name", ["natural_basic", "corporate_relations", "natural_contact"])
def test_stable_under_partitioning(spark, src_small, name):
    fn = datasets.DATASETS[name][1]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = fn(src_small, FIXTURE_PARAMS).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = fn(src_small, FIXTURE_PARAMS).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)


@pytest.mark.parametrize("cls", ["corporate", "natural"])
def test_member_ids_equal_population_ids(src_small, cls):
    from custmaster.operators.population import member_ids
    src = src_small
    ids = member_ids(src.party, src.policy, src.insured, datasets.CLASSES[cls], FIXTURE_PARAMS)
    same_rows(ids, datasets.class_population(src, cls, FIXTURE_PARAMS).select("customer_id"))


def test_one_pass_populations_equal_per_class(src_small):
    from custmaster.operators.population import populations_by_class
    src = src_small
    both = populations_by_class(src.party, src.policy, src.insured, datasets.CLASSES, FIXTURE_PARAMS)
    for cls in datasets.CLASSES:
        one = both.filter(F.col("_class") == cls).drop("_class")
        same_rows(one, datasets.class_population(src, cls, FIXTURE_PARAMS))
