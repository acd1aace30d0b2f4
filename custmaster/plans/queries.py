"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

One key per operator of the inventory (SURVEY section 2) plus the eight
datasets.  Every query reads whole fixture tables (no id subsets, no caps);
the fixture business date is ``params.FIXTURE_AS_OF``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custmaster.functions import codes
from custmaster.functions.columns import (birth_digit, flag_or_zero, non_blank, stamp, text,
                                          usable_income)
from custmaster.operators import address, audit, income, population, relations, risk
from custmaster.operators.asof import as_of_join
from custmaster.operators.contacts import distinct_contacts
from custmaster.operators.history import History
from custmaster.operators.recode import MAJOR, MINOR, recoded
from custmaster.operators.release import Release
from custmaster.operators.state import LatestParty
from custmaster.params import CORPORATE_ID_TYPES, FIXTURE_PARAMS, NATURAL_ID_TYPES, RunParams
from custmaster.plans import datasets
from custmaster.sources import PARTY_COLUMNS, Sources

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources.from_fixtures(spark, sf_dir)


# --- the eight datasets ------------------------------------------------------

def _dataset(name: str, **kw) -> Query:
    _, fn = datasets.DATASETS[name]
    return lambda spark, sf_dir: fn(_src(spark, sf_dir), FIXTURE_PARAMS, **kw)


for _name in datasets.DATASETS:
    REGISTRY[_name] = _dataset(_name)

REGISTRY["natural_relations_with_insured"] = _dataset("natural_relations", with_insured=True)


REGISTRY["natural_basic_two_sources"] = lambda spark, sf_dir: datasets.natural_basic(
    Sources.from_fixtures(spark, sf_dir, "income_extra"), FIXTURE_PARAMS)


def _with_role(name: str, role: str) -> Query:
    return lambda spark, sf_dir: datasets.DATASETS[name][1](Sources.from_fixtures(spark, sf_dir, role), FIXTURE_PARAMS)


for _name in ("corporate_risk", "natural_risk"):
    REGISTRY[f"{_name}_with_products"] = _with_role(_name, "product_risk")
for _name in ("corporate_basic", "natural_basic"):
    REGISTRY[f"{_name}_recoded"] = _with_role(_name, "industry_codes")


@register("asof_product_rating")
def asof_product_rating(spark, sf_dir):
    """Every contract with the product rating that was valid when the contract ended."""
    src = Sources.from_fixtures(spark, sf_dir, "product_risk")
    return as_of_join(src.policy.select("contract_no", "end_datetime"), src.product_risk, ["contract_no"],
                      "end_datetime", "valid_from", ["product_code", "risk_level"])


@register("recode_industry")
def recode_industry(spark, sf_dir):
    src = Sources.from_fixtures(spark, sf_dir, "industry_codes")
    p = src.party.select("contract_no", F.col("occu_type1_code").alias("INDUSTRY_TYPE1"),
                         F.col("occu_type2_code").alias("INDUSTRY_TYPE2"))
    p = recoded(p, "INDUSTRY_TYPE1", src.industry_codes, MAJOR, FIXTURE_PARAMS.as_of)
    return recoded(p, "INDUSTRY_TYPE2", src.industry_codes, MINOR, FIXTURE_PARAMS.as_of)

REGISTRY["corporate_basic_with_address"] = _dataset("corporate_basic", with_address=True)
REGISTRY["natural_basic_with_address"] = _dataset("natural_basic", with_address=True)
REGISTRY["corporate_contact_with_address"] = _dataset("corporate_contact", with_address=True)
REGISTRY["natural_contact_with_address"] = _dataset("natural_contact", with_address=True)


# --- scans, projections, filters ---------------------------------------------

@register("scan_party")
def scan_party(spark, sf_dir):
    return _src(spark, sf_dir).party


@register("project_basic")
def project_basic(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return p.select(
        text("customer_id").alias("ID_NO"),
        F.lit(FIXTURE_PARAMS.source_tag).alias("SOURCE"),
        text("customer_name").alias("C_FULLNAME"),
        F.lit("").alias("E_FULLNAME"),
        text("entity_settime").alias("BUILD_DATE"),
        text("entity_reg_ctycode").alias("COUNTRY"),
        text("occu_type1_code").alias("INDUSTRY_TYPE1"),
        text("occu_type3_code").alias("INDUSTRY_TYPE2"),
        text("bearer_shares_status").alias("IS_BEARER_SHARES"),
    )


@register("audit_stamp")
def audit_stamp(spark, sf_dir):
    pop = datasets.class_population(_src(spark, sf_dir), "corporate", FIXTURE_PARAMS)
    return pop.select(text("customer_id").alias("ID_NO"),
                      stamp(FIXTURE_PARAMS.as_of).alias("LAST_MODIFIED_DATE"),
                      stamp(FIXTURE_PARAMS.create_date).alias("CREATE_DATE"))


@register("filter_policy_status")
def filter_policy_status(spark, sf_dir):
    pol = _src(spark, sf_dir).policy
    return pol.filter(F.col("policy_status") == FIXTURE_PARAMS.policy_status)


@register("filter_id_type")
def filter_id_type(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return (p.filter(F.col("idntfctn_type").isin(*NATURAL_ID_TYPES))
            .select("contract_no", "customer_id", "idntfctn_type"))


@register("policies_in_force")
def policies_in_force(spark, sf_dir):
    return population.policies_in_force(_src(spark, sf_dir).policy, FIXTURE_PARAMS)


@register("filter_non_blank")
def filter_non_blank(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return (p.filter(non_blank("cellular_phone"))
            .select("contract_no", "customer_id", "cellular_phone"))


@register("filter_income_usable")
def filter_income_usable(spark, sf_dir):
    src = _src(spark, sf_dir)
    inc = src.income.filter(usable_income(F.col("pay_source"), F.col("min_year_income")))
    j = inc.join(src.party.select("contract_no", "customer_id"), "contract_no", "left")
    return (j.filter(F.col("customer_id").isNotNull())
            .select("contract_no", "customer_id", "pay_source", "min_year_income",
                    "change_date_time"))


@register("address_on_date")
def address_on_date(spark, sf_dir):
    a = _src(spark, sf_dir).party_address
    return address.on_business_date(a, "dbc_business_date", FIXTURE_PARAMS.as_of)


# --- joins -------------------------------------------------------------------

@register("join_policy_insured")
def join_policy_insured(spark, sf_dir):
    src = _src(spark, sf_dir)
    return population.insured_on_policies(src.policy, src.insured, FIXTURE_PARAMS)


@register("semi_active_customers")
def semi_active_customers(spark, sf_dir):
    src = _src(spark, sf_dir)
    ids = population.active_customer_ids(src.policy, src.insured, FIXTURE_PARAMS)
    return (src.party.join(ids, "customer_id", "left_semi")
            .select("contract_no", "customer_id", "idntfctn_type"))


@register("left_join_income")
def left_join_income(spark, sf_dir):
    from custmaster.operators.profiles import with_income
    src = _src(spark, sf_dir)
    pop = datasets.class_population(src, "natural", FIXTURE_PARAMS)
    return with_income(pop, src.party, src.income).select(
        "customer_id", F.col("_inc_source").alias("pay_source"),
        F.col("_inc_amount").alias("min_year_income"))


@register("left_join_contract_party")
def left_join_contract_party(spark, sf_dir):
    src = _src(spark, sf_dir)
    return (src.policy_agent.join(src.party.select("contract_no", "customer_id"),
                                  "contract_no", "left")
            .select("contract_no", "agent_id", "customer_id"))


@register("left_join_party_role")
def left_join_party_role(spark, sf_dir):
    src = _src(spark, sf_dir)
    nat = src.party.select(F.col("customer_id").alias("_nid"), "national_country_code")
    ins = src.insured.select("contract_no", "customer_id")
    return (ins.join(nat, ins["customer_id"] == nat["_nid"], "left")
            .select("contract_no", "customer_id", "national_country_code"))


@register("left_join_manager")
def left_join_manager(spark, sf_dir):
    src = _src(spark, sf_dir)
    em = src.entity_manager.select(
        "idntfctn_type", "customer_id", F.col("manager_name").alias("em_manager_name"),
        F.col("birthday").alias("em_birthday"),
        F.col("national_country_code").alias("em_country"))
    return (src.party.select("contract_no", "idntfctn_type", "customer_id")
            .join(em, ["idntfctn_type", "customer_id"], "left")
            .select("contract_no", "customer_id", "idntfctn_type", "em_manager_name",
                    "em_birthday", "em_country"))


@register("lookup_industry_risk")
def lookup_industry_risk(spark, sf_dir):
    src = _src(spark, sf_dir)
    pop = datasets.class_population(src, "natural", FIXTURE_PARAMS)
    j = risk.with_risk_lookups(pop, src.param_lookup, src.country_risk, FIXTURE_PARAMS)
    return j.select("customer_id", "risk_industry_code", F.col("_ind_data1").alias("data1"))


@register("lookup_country_risk")
def lookup_country_risk(spark, sf_dir):
    src = _src(spark, sf_dir)
    pop = datasets.class_population(src, "natural", FIXTURE_PARAMS)
    j = risk.with_risk_lookups(pop, src.param_lookup, src.country_risk, FIXTURE_PARAMS)
    return j.select("customer_id", "ocr_country_code", F.col("_cty_level").alias("risk_level"))


# --- aggregates, windows -------------------------------------------------------

def _profile_all(spark, sf_dir) -> DataFrame:
    src = _src(spark, sf_dir)
    return income.income_profile(src.income, income.contract_customer_bridge(src.party))


@register("income_profile")
def income_profile(spark, sf_dir):
    return _profile_all(spark, sf_dir)


@register("agg_pay_source_set")
def agg_pay_source_set(spark, sf_dir):
    return _profile_all(spark, sf_dir).select("customer_id", "pay_source")


@register("agg_latest_income")
def agg_latest_income(spark, sf_dir):
    return _profile_all(spark, sf_dir).select("customer_id", "min_year_income")


@register("distinct_contacts")
def distinct_contacts_q(spark, sf_dir):
    return distinct_contacts(_src(spark, sf_dir).party)


@register("active_customer_ids")
def active_customer_ids(spark, sf_dir):
    src = _src(spark, sf_dir)
    return population.active_customer_ids(src.policy, src.insured, FIXTURE_PARAMS)


@register("latest_party")
def latest_party(spark, sf_dir):
    p = population.latest_party(_src(spark, sf_dir).party, NATURAL_ID_TYPES)
    return p.select("customer_id", "contract_no", "change_date_time", "idntfctn_type")


@register("population_natural")
def population_natural(spark, sf_dir):
    pop = datasets.class_population(_src(spark, sf_dir), "natural", FIXTURE_PARAMS)
    return pop.select("customer_id", "contract_no", "idntfctn_type", "change_date_time")


@register("population_corporate")
def population_corporate(spark, sf_dir):
    pop = datasets.class_population(_src(spark, sf_dir), "corporate", FIXTURE_PARAMS)
    return pop.select("customer_id", "contract_no", "idntfctn_type", "change_date_time")


@register("latest_registered_address")
def latest_registered_address(spark, sf_dir):
    return address.latest_registered_address(_src(spark, sf_dir).party_address)


@register("contact_address_arms")
def contact_address_arms(spark, sf_dir):
    a = _src(spark, sf_dir).party_address
    return address.address_contact_rows(a, natural=True,
                                        business_date=FIXTURE_PARAMS.as_of).distinct()


@register("population_incremental")
def population_incremental(spark, sf_dir):
    """The natural persons' population from a state of the latest party rows that grew in four steps:
    the history up to a day, three more days' rows (the last step has all later ones)."""
    src = _src(spark, sf_dir)
    cuts = [None, "2001-05-29", "2001-05-30", "2001-05-31", None]
    state = LatestParty(spark, audit.shared_path(spark, "latest-party"), datasets.CLASSES, PARTY_COLUMNS)
    time = F.col("change_date_time")
    for low, high in zip(cuts, cuts[1:]):
        rows = src.party
        rows = rows.where(time >= F.lit(low).cast("timestamp_ntz")) if low else rows
        rows = rows.where((time < F.lit(high).cast("timestamp_ntz")) | (time.isNull() if low is None else F.lit(False))) if high else rows
        state.add(rows)
    pop = state.population("natural", src.policy, src.insured, FIXTURE_PARAMS)
    return pop.select("customer_id", "contract_no", "idntfctn_type", "change_date_time")


# --- scalar maps ---------------------------------------------------------------

@register("try_cast_income")
def try_cast_income(spark, sf_dir):
    inc = _src(spark, sf_dir).income
    return inc.select("contract_no", "change_date_time",
                      F.col("pay_source").try_cast("string").alias("INVEST_SOURCE"),
                      F.col("min_year_income").try_cast("string").alias("ANNUAL_INCOME"))


@register("map_job_title")
def map_job_title(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return p.select("contract_no", "risk_jobtitle_code",
                    codes.job_title(F.col("risk_jobtitle_code")).alias("INDUSTRY_TITLE"))


@register("map_pay_source")
def map_pay_source(spark, sf_dir):
    inc = _src(spark, sf_dir).income
    return inc.select("contract_no", "change_date_time", "pay_source",
                      codes.pay_source_text(F.col("pay_source")).alias("PAY_SOURCE_TEXT"))


@register("map_risk_level")
def map_risk_level(spark, sf_dir):
    src = _src(spark, sf_dir)
    cty = risk.country_risk_lookup(src.country_risk)
    p = src.party.select("contract_no", "risk_level", "ocr_country_code")
    j = p.join(cty, p["ocr_country_code"] == cty["_cty_code"], "left")
    return j.select("contract_no",
                    codes.customer_risk(F.col("risk_level")).alias("RISK_LEVEL"),
                    codes.country_risk(F.col("_cty_level")).alias("COUNTRY_RISK"))


@register("map_id_type_gender")
def map_id_type_gender(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return p.select("contract_no", codes.id_type(F.col("idntfctn_type")).alias("ID_TYPE"),
                    codes.gender(F.col("sex")).alias("GENDER"))


@register("bucket_birth_digit")
def bucket_birth_digit(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return p.select("contract_no", "birthday", birth_digit(F.col("birthday")).alias("PTN"))


@register("flags_default_zero")
def flags_default_zero(spark, sf_dir):
    p = _src(spark, sf_dir).party
    return p.select("contract_no",
                    flag_or_zero(F.col("san")).alias("IS_SAN"),
                    flag_or_zero(F.col("mny_err")).alias("IS_PROHIBITEDLIST"),
                    flag_or_zero(F.col("sip")).alias("IS_SIP"),
                    flag_or_zero(F.col("am")).alias("IS_AME"),
                    flag_or_zero(F.col("pep")).alias("IS_PEP"),
                    flag_or_zero(F.col("rca")).alias("IS_RCA"))


@register("manager_name_fallback")
def manager_name_fallback(spark, sf_dir):
    src = _src(spark, sf_dir)
    em = src.entity_manager.select("idntfctn_type", "customer_id",
                                   F.col("manager_name").alias("_em_name"))
    j = (src.party.select("contract_no", "idntfctn_type", "customer_id", "manager_name")
         .join(em, ["idntfctn_type", "customer_id"], "left"))
    return j.select("contract_no",
                    F.coalesce(F.col("_em_name"), F.col("manager_name")).alias("C_FULLNAME"))


# --- relation arms in the source's own shape (NULL ids of unknown contracts kept) ---

def _raw_bridge(src: Sources) -> DataFrame:
    return income.contract_customer_bridge(src.party, keep_null=True)


@register("arm_agent")
def arm_agent(spark, sf_dir):
    src = _src(spark, sf_dir)
    return relations.as_arm(relations.agent_rows(src.policy_agent, _raw_bridge(src), how="left"))


@register("arm_insured")
def arm_insured(spark, sf_dir):
    src = _src(spark, sf_dir)
    nat = relations.person_bridge(src.party, ["national_country_code"])
    return relations.as_arm(relations.insured_rows(src.insured, _raw_bridge(src), nat,
                                                   how="left"))


@register("arm_insured_natural")
def arm_insured_natural(spark, sf_dir):
    src = _src(spark, sf_dir)
    return relations.as_arm(relations.natural_insured_rows(
        src.insured, income.contract_customer_bridge(src.party)))


@register("arm_benef_health")
def arm_benef_health(spark, sf_dir):
    src = _src(spark, sf_dir)
    per = relations.person_bridge(src.party, ["birthday", "national_country_code"])
    return relations.as_arm(relations.health_beneficiary_rows(
        src.benef_health, _raw_bridge(src), per, how="left"))


@register("arm_benef_travel")
def arm_benef_travel(spark, sf_dir):
    src = _src(spark, sf_dir)
    return relations.as_arm(relations.travel_beneficiary_rows(src.benef_travel,
                                                              _raw_bridge(src), how="left"))


@register("arm_manager")
def arm_manager(spark, sf_dir):
    src = _src(spark, sf_dir)
    return relations.as_arm(relations.manager_rows(src.party, src.entity_manager))


@register("union_relation_arms")
def union_relation_arms(spark, sf_dir):
    parts = [arm_agent, arm_insured, arm_benef_health, arm_benef_travel, arm_manager]
    out = None
    for p in parts:
        df = p(spark, sf_dir)
        out = df if out is None else out.unionByName(df)
    return out


# --- audit, publish, snapshot ------------------------------------------------------

@register("audit_counts")
def audit_counts(spark, sf_dir):
    src = _src(spark, sf_dir)
    pops = {c: datasets.class_population(src, c, FIXTURE_PARAMS) for c in ("corporate", "natural")}
    out = None
    for name, (cls, fn) in datasets.DATASETS.items():
        c = audit.audit_counts(fn(src, FIXTURE_PARAMS, pop=pops[cls]), name)
        out = c if out is None else out.unionByName(c)
    return out


@register("audit_relation_types")
def audit_relation_types(spark, sf_dir):
    df = datasets.corporate_relations(_src(spark, sf_dir), FIXTURE_PARAMS)
    return audit.audit_counts(df, "corporate_relations", by=["RELATION_TYPE"])


@register("publish_roundtrip")
def publish_roundtrip(spark, sf_dir):
    df = datasets.natural_contact(_src(spark, sf_dir), FIXTURE_PARAMS)
    return audit.publish_roundtrip(spark, df, "natural_contact")


# three runs: customers whose policies end between the second day and the third
# leave and come back
SNAPSHOT_RUNS = tuple(RunParams(as_of=dt.date.fromisoformat(day), create_date=dt.date.fromisoformat(first))
                      for day, first in (("2001-03-01", "2001-01-01"), ("2001-07-15", "2001-02-01"),
                                         ("2001-06-01", "2001-03-01")))


@register("snapshot_merge")
def snapshot_merge(spark, sf_dir):
    """Three runs, published one after another; the first-creation history grows with each."""
    src = _src(spark, sf_dir)
    release = Release(spark, audit.shared_path(spark, "snapshots"))
    history = History(spark, audit.shared_path(spark, "snapshot-history"))
    for params in SNAPSHOT_RUNS:
        run = release.begin()
        run.write("natural_risk", history.with_first_created(datasets.natural_risk(src, params)))
        run.commit()
        history.add_segment(release.read("natural_risk"))
    return release.read("natural_risk")


@register("release_reuse")
def release_reuse(spark, sf_dir):
    """Natural contacts published for a day, then as of a day on which other customers are in
    force: the partitions that did not change come from the first version."""
    src = _src(spark, sf_dir)
    release = Release(spark, audit.shared_path(spark, "reuse"))
    for day in (SNAPSHOT_RUNS[0].as_of, FIXTURE_PARAMS.as_of, FIXTURE_PARAMS.as_of):
        params = RunParams(as_of=day)
        run = release.begin()
        run.write("natural_contact", datasets.natural_contact(src, params), reuse=True)
        run.commit()
    return release.read("natural_contact")


@register("release_counts")
def release_counts(spark, sf_dir):
    """Records of both classes' contacts, counted while they were written (ids: see the tests)."""
    src = _src(spark, sf_dir)
    release = Release(spark, audit.shared_path(spark, "counts"))
    run = release.begin()
    for name in ("corporate_contact", "natural_contact"):
        run.write(name, datasets.DATASETS[name][1](src, FIXTURE_PARAMS))
    run.commit()
    return release.counts().select("dataset", "records")


@register("audit_relation_types_natural")
def audit_relation_types_natural(spark, sf_dir):
    df = datasets.natural_relations(_src(spark, sf_dir), FIXTURE_PARAMS)
    return audit.audit_counts(df, "natural_relations", by=["RELATION_TYPE"])
