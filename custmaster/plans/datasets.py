"""The eight published datasets, built from a ``Sources`` bundle.

Each builder takes the bundle, the run parameters and optionally a
precomputed population (the daily batch computes each class's population
once and reuses it for four datasets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from custmaster.operators import contacts, profiles, relations, risk
from custmaster.operators.address import latest_registered_address
from custmaster.operators.income import contract_customer_bridge
from custmaster.operators.population import active_customer_ids, member_ids, policies_in_force, population
from custmaster.operators.recode import MAJOR, MINOR, recoded
from custmaster.params import CORPORATE_ID_TYPES, NATURAL_ID_TYPES, RunParams
from custmaster.sources import Sources

CLASSES = {"corporate": CORPORATE_ID_TYPES, "natural": NATURAL_ID_TYPES}


def class_population(src: Sources, cls: str, params: RunParams) -> DataFrame:
    return population(src.party, src.policy, src.insured, CLASSES[cls], params)


def _industry(src: Sources, df: DataFrame, params: RunParams) -> DataFrame:
    """The industry columns converted where a configuration table is bound, else the source's codes."""
    if not src.has("industry_codes"):
        return df
    for column, kind in (("INDUSTRY_TYPE1", MAJOR), ("INDUSTRY_TYPE2", MINOR)):
        df = recoded(df, column, src.industry_codes, kind, params.as_of)
    return df


def _products(src: Sources, pop: DataFrame, ids: DataFrame, params: RunParams) -> DataFrame | None:
    if not src.has("product_risk"):
        return None
    bridge = contract_customer_bridge(src.party, ids, pairs=src.derived("pairs"))
    return risk.product_ratings(src.product_risk, bridge, policies_in_force(src.policy, params), params)


def corporate_basic(src: Sources, params: RunParams,
                    pop: DataFrame | None = None, with_address: bool = False) -> DataFrame:
    ids = None
    if pop is None:
        pop = class_population(src, "corporate", params)
        ids = active_customer_ids(src.policy, src.insured, params)
    addr = latest_registered_address(src.party_address) if with_address else None
    return _industry(src, profiles.corporate_basic(pop, src.party, src.declarations(), params, addr, ids,
                                                   src.derived("pairs")), params)


def natural_basic(src: Sources, params: RunParams,
                  pop: DataFrame | None = None, with_address: bool = False) -> DataFrame:
    ids = None
    if pop is None:
        pop = class_population(src, "natural", params)
        ids = active_customer_ids(src.policy, src.insured, params)
    addr = latest_registered_address(src.party_address) if with_address else None
    return _industry(src, profiles.natural_basic(pop, src.party, src.declarations(), params, addr, ids,
                                                 src.derived("pairs")), params)


def _pop_and_ids(src: Sources, pop: DataFrame | None, cls: str, params: RunParams) -> tuple[DataFrame, DataFrame]:
    """The population, and ids (once each) that hold all of its: without a written population the
    active ids, which need no second ranking."""
    if pop is not None:
        return pop, pop.select("customer_id")
    return class_population(src, cls, params), active_customer_ids(src.policy, src.insured, params)


def corporate_contact(src: Sources, params: RunParams,
                      pop: DataFrame | None = None, with_address: bool = False) -> DataFrame:
    pop, ids = _pop_and_ids(src, pop, "corporate", params)
    return contacts.corporate_contact(pop, src.party, params,
                                      src.party_address if with_address else None,
                                      src.derived("contacts"), ids)


def natural_contact(src: Sources, params: RunParams,
                    pop: DataFrame | None = None, with_address: bool = False) -> DataFrame:
    pop, ids = _pop_and_ids(src, pop, "natural", params)
    return contacts.natural_contact(pop, src.party, params,
                                    src.party_address if with_address else None,
                                    src.derived("contacts"), ids)


def corporate_relations(src: Sources, params: RunParams,
                        pop: DataFrame | None = None) -> DataFrame:
    # only the population's ids are used here: no ranking needed
    pop = pop if pop is not None else member_ids(src.party, src.policy, src.insured,
                                                 CORPORATE_ID_TYPES, params)
    return relations.corporate_relations(pop, src.party, src.policy_agent, src.insured,
                                         src.benef_health, src.benef_travel,
                                         src.entity_manager, params,
                                         src.derived("pairs"), src.derived("persons"))


def natural_relations(src: Sources, params: RunParams,
                      pop: DataFrame | None = None, with_insured: bool = False) -> DataFrame:
    pop = pop if pop is not None else class_population(src, "natural", params)
    return relations.natural_relations(pop, src.party, src.policy_agent, src.insured,
                                       src.benef_health, src.benef_travel, params,
                                       with_insured, src.derived("pairs"),
                                       src.derived("persons"))


def _risk(src: Sources, params: RunParams, pop: DataFrame | None, cls: str, build) -> DataFrame:
    pop, ids = _pop_and_ids(src, pop, cls, params)
    return build(pop, src.param_lookup, src.country_risk, params, _products(src, pop, ids, params))


def corporate_risk(src: Sources, params: RunParams,
                   pop: DataFrame | None = None) -> DataFrame:
    return _risk(src, params, pop, "corporate", risk.corporate_risk)


def natural_risk(src: Sources, params: RunParams,
                 pop: DataFrame | None = None) -> DataFrame:
    return _risk(src, params, pop, "natural", risk.natural_risk)


DATASETS = {
    "corporate_basic": ("corporate", corporate_basic),
    "corporate_contact": ("corporate", corporate_contact),
    "corporate_relations": ("corporate", corporate_relations),
    "corporate_risk": ("corporate", corporate_risk),
    "natural_basic": ("natural", natural_basic),
    "natural_contact": ("natural", natural_contact),
    "natural_relations": ("natural", natural_relations),
    "natural_risk": ("natural", natural_risk),
}
