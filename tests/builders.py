"""Hand-made source rows for semantic tests (schemas as the fixture adapters)."""

from __future__ import annotations

import datetime as dt

from custmaster.sources import Sources

SCHEMAS = {
    "party": """contract_no bigint, customer_id bigint, idntfctn_type string, customer_name string,
        change_date_time timestamp_ntz, sex string, birthday string, national_country_code int,
        ocr_country_code bigint, entity_reg_ctycode int, entity_head_ctycode int,
        entity_settime string, occu_type1_code string, occu_type2_code string,
        occu_type3_code string, bearer_shares_status string, risk_jobtitle_code string,
        manager_id string, manager_name string, cellular_phone string, email string,
        risk_level string, risk_level_update timestamp_ntz, san string, mny_err string,
        sip string, am string, pep string, rca string, risk_industry_code string""",
    "policy": "contract_no bigint, policy_status string, end_datetime timestamp_ntz",
    "policy_agent": "contract_no bigint, agent_id bigint",
    "insured": "contract_no bigint, customer_id bigint, customer_name string, birthday string",
    "benef_health": ("contract_no bigint, assured_id bigint, assured_name string, "
                     "relative_to_insured string"),
    "benef_travel": "contract_no bigint, assured_name string, relative_to_insured string",
    "income": ("contract_no bigint, pay_source string, min_year_income bigint, "
               "change_date_time timestamp_ntz"),
    "entity_manager": ("idntfctn_type string, customer_id bigint, manager_name string, "
                       "birthday string, national_country_code int"),
    "param_lookup": "param_id string, display_value string, data1 string",
    "country_risk": "country_code int, risk_level string",
    "party_address": ("customer_id bigint, address_kind string, address string, phone1 string, "
                      "phone2 string, create_date timestamp_ntz, dbc_business_date timestamp_ntz"),
}

PARTY_COLS = [c.strip().split()[0] for c in SCHEMAS["party"].split(",")]


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def party_row(contract_no, customer_id, idntfctn_type="1", when="2000-01-01", **kw):
    base = dict(contract_no=contract_no, customer_id=customer_id, idntfctn_type=idntfctn_type,
                customer_name=f"C{customer_id}", change_date_time=ts(when), sex="M",
                birthday="1980-01-01", national_country_code=1, ocr_country_code=1,
                entity_reg_ctycode=1, entity_head_ctycode=2, entity_settime="1990",
                occu_type1_code="A", occu_type2_code="A-1", occu_type3_code="A-2",
                bearer_shares_status="0", risk_jobtitle_code="T010", manager_id="M1",
                manager_name="Mgr", cellular_phone=f"09{customer_id}", email=None,
                risk_level="00", risk_level_update=ts(when), san=None, mny_err=None, sip=None,
                am=None, pep=None, rca=None, risk_industry_code="AUTOMOBILE")
    base.update(kw)
    return tuple(base[c] for c in PARTY_COLS)


def make_sources(spark, **tables) -> Sources:
    """Sources from lists of tuples; missing roles are empty tables."""
    dfs = {}
    for role, schema in SCHEMAS.items():
        data = tables.get(role, [])
        dfs[role] = spark.createDataFrame(data, schema=schema)
    return Sources(spark, {r: (lambda d=d: d) for r, d in dfs.items()})
