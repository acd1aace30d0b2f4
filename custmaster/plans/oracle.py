"""DuckDB SQL for every registered query, from the inventory's wording.

The statements are put together from a few relations and from tables of
output columns, over the fixture adapters of ``sources.fixture_sql``:

* ``holder``: who a contract belongs to, each (contract, customer) once;
* ``person``: what is known of a person, each combination once;
* ``active``: customers insured on a contract that is live on a day;
* ``member``: a class's customers, the newest history row of each
  (``DISTINCT ON``);
* one statement per kind of related person, all built by ``related``.

Code tables are the fixed values of ``functions.codes``, read as a relation.
"""

from __future__ import annotations

from collections.abc import Mapping

from custmaster.functions import codes
from custmaster.params import CREATE_DATE, FIXTURE_AS_OF
from custmaster.sources.fixture_sql import ADAPTERS

DAY = FIXTURE_AS_OF.isoformat()
FIRST_DAY = CREATE_DATE.isoformat()
TYPES = {"corporate": ("4",), "natural": ("1", "2", "3")}
EMPTY = "''"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def recode(col: str, table: Mapping[str, str], other: str | None = None) -> str:
    """The table's text for a code; else ``other``, or the code itself."""
    pairs = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in table.items())
    return f"coalesce((SELECT v FROM (VALUES {pairs}) code(k, v) WHERE k = {col}), {other or col})"


def txt(col: str) -> str:
    return f"({col})::VARCHAR"


def at(day: str) -> str:
    return f"{quoted(day)}::TIMESTAMP"


def columns(spec: Mapping[str, str]) -> str:
    return ",\n       ".join(f"{expr} AS {name}" for name, expr in spec.items())


def filled(col: str) -> str:
    return f"length({col}) > 0"


def statement(body: str, *relations: str) -> str:
    """``body`` over the adapters and, in order, further relations ``name AS (...)``."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in ADAPTERS.items()] + list(relations)
    return "WITH " + ",\n".join(parts) + "\n" + body


# -- relations ---------------------------------------------------------------------------

HOLDER = "holder AS (SELECT contract_no, customer_id FROM party GROUP BY ALL)"
PERSON = "person AS (SELECT customer_id, birthday, national_country_code FROM party GROUP BY ALL)"


def live(day: str, name: str = "live") -> str:
    return (f"{name} AS (FROM policy SELECT contract_no WHERE policy_status = '7' "
            f"AND coalesce(end_datetime::DATE, 'infinity'::DATE) >= {quoted(day)}::DATE)")


def active(name: str = "active", of: str = "live") -> str:
    return (f"{name} AS (SELECT customer_id FROM insured SEMI JOIN {of} USING (contract_no) "
            "WHERE customer_id IS NOT NULL GROUP BY customer_id)")


def newest(cls: str) -> str:
    wanted = ", ".join(map(quoted, TYPES[cls]))
    return (f"SELECT DISTINCT ON (customer_id) * FROM party WHERE idntfctn_type IN ({wanted}) "
            "ORDER BY customer_id, change_date_time DESC NULLS LAST, contract_no DESC NULLS LAST")


def members(cls: str, day: str = DAY, suffix: str = "") -> tuple[str, ...]:
    """The relation ``member`` of a class on a day, and those it needs."""
    return (live(day, f"live{suffix}"), active(f"active{suffix}", f"live{suffix}"),
            f"member{suffix} AS (FROM ({newest(cls)}) SEMI JOIN active{suffix} USING (customer_id))")


def declared(source: str = "income") -> tuple[str, ...]:
    """``declared``: usable declarations by customer; ``funds``: one row a customer."""
    return (
        HOLDER,
        f"declared AS (SELECT h.customer_id, d.* FROM {source} d JOIN holder h USING (contract_no) "
        f"WHERE h.customer_id IS NOT NULL AND ({filled('d.pay_source')} OR d.min_year_income IS NOT NULL))",
        "kinds AS (SELECT customer_id, coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind), '') AS pay_source "
        f"FROM (SELECT customer_id, {recode('pay_source', codes.PAY_SOURCES)} AS kind FROM declared) GROUP BY customer_id)",
        "newest_amount AS (SELECT DISTINCT ON (customer_id) customer_id, min_year_income FROM declared "
        "ORDER BY customer_id, change_date_time DESC NULLS LAST, contract_no DESC, min_year_income DESC NULLS LAST)",
        "funds AS (FROM kinds JOIN newest_amount USING (customer_id))",
    )


REGISTERED = (
    f"registered AS (SELECT DISTINCT ON (customer_id) customer_id, address FROM party_address "
    f"WHERE address_kind = '1' AND {filled('address')} "
    "ORDER BY customer_id, create_date DESC NULLS LAST, address DESC)")


def reachable(*kinds: tuple[str, str, str]) -> str:
    """Contact rows: (table, contact type, column[, condition]) of each kind, once each."""
    each = [f"SELECT customer_id AS id, {quoted(kind)} AS contact_type, {col} AS content FROM {table} "
            f"WHERE {filled(col)}{''.join(' AND ' + c for c in more)}" for table, kind, col, *more in kinds]
    return "reachable AS (" + " UNION ".join(each) + ")"


PARTY_CONTACTS = (("party", "5", "cellular_phone"), ("party", "6", "email"))
ADDRESS_CONTACTS = {
    "corporate": (("party_address", "1", "address", "address_kind = '3'"),
                  ("party_address", "2", "address", "address_kind = '2'"),
                  ("party_address", "3", "phone1")),
    "natural": (("party_address", "1", "address", "address_kind = '3'", f"dbc_business_date::DATE = '{DAY}'"),
                ("party_address", "2", "address", "address_kind = '2'"),
                ("party_address", "3", "phone1"), ("party_address", "4", "phone2")),
}

# -- columns of the published datasets -----------------------------------------------------

ID_TYPE = recode("m.idntfctn_type", codes.ID_TYPES, quoted(codes.ID_TYPE_DEFAULT))
GENDER = recode("m.sex", codes.GENDERS, quoted(codes.GENDER_DEFAULT))


def digit(col: str) -> str:
    return f"coalesce(nullif(regexp_extract(substring({col}, 4, 1), '[0-9]'), ''), '0')"


def stamps(day: str = DAY, first: str = FIRST_DAY) -> dict[str, str]:
    return {"LAST_MODIFIED_DATE": at(day), "CREATE_DATE": at(first)}


def blanks(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, EMPTY)


WHO = {"ID_NO": txt("m.customer_id"), "SOURCE": "'INS'"}


def converted(col: str, kind: str, day: str = DAY) -> str:
    """A code's target in the configuration on a day, else the code."""
    return (f"coalesce((SELECT max(k.target_code) FROM industry_codes k WHERE k.code_type = '{kind}' AND k.source_code = {col} "
            f"AND {at(day)} BETWEEN coalesce(k.valid_from, '-infinity') AND coalesce(k.valid_to, 'infinity')), {col})")


def basic(cls: str, address: bool = False, source: str = "income", recode_industry: bool = False) -> str:
    money = {"INVEST_SOURCE": txt("f.pay_source")}
    home = {"REGISTERED_ADDR": txt("r.address")} if address else {}
    name = {"C_FULLNAME": txt("m.customer_name")} | blanks("E_FULLNAME")
    trade = {"INDUSTRY_TYPE1": txt("m.occu_type1_code")}
    if cls == "corporate":
        spec = (WHO | name | {"BUILD_DATE": txt("m.entity_settime"), "COUNTRY": txt("m.entity_reg_ctycode")}
                | (home or blanks("REGISTERED_ADDR")) | trade | {"INDUSTRY_TYPE2": txt("m.occu_type3_code")}
                | blanks("ESTATE_SOURCE", "YEAR_PROFIT", "PRODUCT_CUB", "OWNER_STRUCT", "IS_HIDE_OWNER") | money
                | {"PAID_UP_CAPITAL": txt("f.min_year_income"), "IS_BEARER_SHARES": txt("m.bearer_shares_status")})
    else:
        spec = ({"ID_TYPE": ID_TYPE} | WHO | name | {"GENDER": GENDER, "BIRTHDAY_DATE": txt("m.birthday")}
                | blanks("EXPIRED_DATE", "PASSPORT_NUMBER", "PASSPORT_VALIDITY")
                | {"COUNTRY": txt("m.national_country_code")} | home
                | blanks("O_NAME", "EDUCATION_CODE", "SERVICES", "ESTATE_SOURCE", "PRODUCT_CUB") | trade
                | {"INDUSTRY_TYPE2": txt("m.occu_type2_code"),
                   "INDUSTRY_TITLE": recode("m.risk_jobtitle_code", codes.JOB_TITLES)}
                | money | {"ANNUAL_INCOME": txt("f.min_year_income")})
    if recode_industry:
        spec |= {f"INDUSTRY_TYPE{k}": converted(spec[f"INDUSTRY_TYPE{k}"], str(k)) for k in (1, 2)}
    body = f"SELECT {columns(spec | stamps())}\nFROM member m LEFT JOIN funds f USING (customer_id)"
    if address:
        body += " LEFT JOIN registered r USING (customer_id)"
    return statement(body, *members(cls), *declared(source), *([REGISTERED] if address else []))


def contact(cls: str, *kinds) -> str:
    country = {"corporate": "entity_head_ctycode", "natural": "ocr_country_code"}[cls]
    spec = (WHO | {"COUNTRY": txt(f"m.{country}"), "CONTACT_TYPE": "c.contact_type", "CONTENT": "c.content",
                   "STATUS": "'1'"} | stamps())
    if cls == "natural":
        spec = {"ID_TYPE": ID_TYPE} | spec | {"PTN": digit("m.birthday")}
    return statement(f"SELECT {columns(spec)}\nFROM reachable c JOIN member m ON m.customer_id = c.id",
                     *members(cls), reachable(*kinds))


def risk_columns(cls: str, day: str = DAY, first: str = FIRST_DAY) -> dict[str, str]:
    listed = {"IS_SAN": "san", "IS_PROHIBITEDLIST": "mny_err", "IS_SIP": "sip", "IS_AME": "am", "IS_PEP": "pep",
              "IS_RCA": "rca"}
    spec = (WHO | {"RISK_LEVEL": recode("m.risk_level", codes.CUSTOMER_RISK),
                   "RISK_MODIFY_DATE": txt("m.risk_level_update"),
                   "IS_CFH_PROHIBITEDLIST": "'0'", "IS_CFH_SIP": "'0'"}
            | {name: f"ifnull(m.{col}, '0')" for name, col in listed.items()}
            | {"INDUSTRY_RISK": recode("i.data1", codes.INDUSTRY_RISK)} | blanks("PROD_CXL_APC", "PROD_RISK_CXL_APC")
            | {"COUNTRY_RISK": recode("k.risk_level", codes.COUNTRY_RISK)} | stamps(day, first))
    return ({"ID_TYPE": ID_TYPE} if cls == "natural" else {}) | spec


INDUSTRY = ("industry AS (FROM param_lookup SELECT display_value, data1 "
            "WHERE param_id = 'RISK_INDUSTRY_TYPE')")


def rated(member: str = "member") -> str:
    return (f"{member} m LEFT JOIN industry i ON i.display_value = m.risk_industry_code "
            "LEFT JOIN country_risk k ON k.country_code = m.ocr_country_code")


def risk(cls: str) -> str:
    return statement(f"SELECT {columns(risk_columns(cls))}\nFROM {rated()}", *members(cls), INDUSTRY)


#: each product of a live contract with the newest of its ratings up to the day
RATED_PRODUCTS = (
    f"rated AS (SELECT DISTINCT ON (contract_no, product_code) contract_no, product_code, risk_level "
    f"FROM product_risk SEMI JOIN live USING (contract_no) WHERE valid_from <= {at(DAY)} "
    "ORDER BY contract_no, product_code, valid_from DESC, risk_level DESC)",
    "products AS (SELECT customer_id, string_agg(DISTINCT product_code, ',' ORDER BY product_code) AS kinds, "
    f"max({recode('risk_level', codes.COUNTRY_RISK)}) AS worst FROM rated JOIN holder USING (contract_no) GROUP BY customer_id)")


def risk_with_products(cls: str) -> str:
    spec = risk_columns(cls) | {"PROD_CXL_APC": "coalesce(q.kinds, '')", "PROD_RISK_CXL_APC": "coalesce(q.worst, '')"}
    return statement(f"SELECT {columns(spec)}\nFROM {rated()} LEFT JOIN products q ON q.customer_id = m.customer_id",
                     *members(cls), INDUSTRY, HOLDER, *RATED_PRODUCTS)


# -- related persons -----------------------------------------------------------------------

FACTS = ("C_FULLNAME", "REPRESNT_POS", "RELATION_CODE", "BIRTHDAY_DATE", "RELATION_ID_NO", "COUNTRY")


def related(kind: int, frm: str, holder: str = "h.customer_id", where: str = "", **facts: str) -> str:
    """One kind of related person: the holder's id, the kind, and the facts, each row once."""
    spec = {"ID": txt(holder), "RELATION_TYPE": f"{kind}::INTEGER"}
    spec |= {f: txt(facts[f]) if f in facts else "NULL::VARCHAR" for f in FACTS}
    return f"SELECT DISTINCT {columns(spec)}\nFROM {frm}{' WHERE ' + where if where else ''}"


def agents(kind: int = 1) -> str:
    return related(kind, "policy_agent l LEFT JOIN holder h USING (contract_no)", RELATION_ID_NO="l.agent_id")


def insured_persons(kind: int) -> str:
    facts = {"C_FULLNAME": "l.customer_name", "BIRTHDAY_DATE": "l.birthday", "RELATION_ID_NO": "l.customer_id"}
    frm = "insured l LEFT JOIN holder h USING (contract_no)"
    if kind == codes.REL_INSURED_NATURAL:
        return related(kind, frm, where="h.customer_id IS NOT NULL", **facts)
    return related(kind, frm + " LEFT JOIN person p ON p.customer_id = l.customer_id",
                   COUNTRY="p.national_country_code", **facts)


def health(kind: int) -> str:
    return related(kind, "benef_health l LEFT JOIN holder h USING (contract_no) "
                         "LEFT JOIN person p ON p.customer_id = l.assured_id",
                   C_FULLNAME="l.assured_name", RELATION_CODE="l.relative_to_insured", BIRTHDAY_DATE="p.birthday",
                   RELATION_ID_NO="l.assured_id", COUNTRY="p.national_country_code")


def travel(kind: int) -> str:
    return related(kind, "benef_travel l LEFT JOIN holder h USING (contract_no)",
                   C_FULLNAME="l.assured_name", RELATION_CODE="l.relative_to_insured")


MANAGED = "party m LEFT JOIN entity_manager e USING (idntfctn_type, customer_id)"


def managers(kind: int) -> str:
    return related(kind, MANAGED, holder="m.customer_id", C_FULLNAME="ifnull(e.manager_name, m.manager_name)",
                   REPRESNT_POS=recode("m.risk_jobtitle_code", codes.JOB_TITLES), BIRTHDAY_DATE="e.birthday",
                   RELATION_ID_NO="m.manager_id", COUNTRY="e.national_country_code")


def union(*arms: str) -> str:
    return " UNION ALL ".join(f"({a})" for a in arms)


CORPORATE_ARMS = (agents(), insured_persons(8), health(9), travel(9), managers(2), managers(3))
NATURAL_ARMS = (agents(), health(5), travel(5))


def relations(cls: str, arms: tuple[str, ...]) -> str:
    kept = FACTS if cls == "corporate" else [f for f in FACTS if f != "REPRESNT_POS"]
    spec = WHO | {"RELATION_TYPE": txt("r.RELATION_TYPE")} | {f: f"r.{f}" for f in kept} | stamps()
    if cls == "natural":
        spec = {"ID_TYPE": ID_TYPE} | spec | {"PTN": digit("m.birthday")}
    return statement(f"SELECT {columns(spec)}\nFROM related r JOIN member m ON m.customer_id::VARCHAR = r.ID",
                     *members(cls), HOLDER, PERSON, f"related AS ({union(*arms)})")


def arm(*arms: str) -> str:
    return statement(f"FROM ({union(*arms)})", HOLDER, PERSON)


DATASETS = {
    "corporate_basic": basic("corporate"),
    "corporate_contact": contact("corporate", *PARTY_CONTACTS),
    "corporate_relations": relations("corporate", CORPORATE_ARMS),
    "corporate_risk": risk("corporate"),
    "natural_basic": basic("natural"),
    "natural_contact": contact("natural", *PARTY_CONTACTS),
    "natural_relations": relations("natural", NATURAL_ARMS),
    "natural_risk": risk("natural"),
}


# -- operators one by one ------------------------------------------------------------------

def counted(name: str, *by: str) -> str:
    group = "".join(f"{b}, " for b in by)
    return (f"SELECT {quoted(name)} AS dataset, {group}count(*) AS records, count(DISTINCT ID_NO) AS distinct_ids "
            f"FROM ({DATASETS[name]}) GROUP BY ALL")


def first_created(days: tuple[tuple[str, str], ...]) -> str:
    """Risk rows of the last (day, stamp), each created when its id was first seen on any of the days."""
    parts, seen = [INDUSTRY], []
    for n, (day, first) in enumerate(days):
        parts += members("natural", day, str(n))
        seen.append(f"SELECT customer_id, {at(first)} AS stamp FROM member{n}")
    last = len(days) - 1
    spec = risk_columns("natural", *days[last]) | {"CREATE_DATE": "b.born"}
    return statement(
        f"SELECT {columns(spec)}\nFROM {rated(f'member{last}')} JOIN born b USING (customer_id)",
        *parts, f"born AS (SELECT customer_id, min(stamp) AS born FROM ({' UNION ALL '.join(seen)}) GROUP BY ALL)")


SNAPSHOTS = (("2001-03-01", "2001-01-01"), ("2001-07-15", "2001-02-01"), ("2001-06-01", "2001-03-01"))

PROJECTED = WHO | {"C_FULLNAME": txt("m.customer_name"), "E_FULLNAME": EMPTY, "BUILD_DATE": txt("m.entity_settime"),
                   "COUNTRY": txt("m.entity_reg_ctycode"), "INDUSTRY_TYPE1": txt("m.occu_type1_code"),
                   "INDUSTRY_TYPE2": txt("m.occu_type3_code"), "IS_BEARER_SHARES": txt("m.bearer_shares_status")}
IDENTITY = "customer_id, contract_no, idntfctn_type, change_date_time"

ORACLES: dict[str, str] = DATASETS | {
    "natural_relations_with_insured": relations("natural", (*NATURAL_ARMS, insured_persons(4))),
    "corporate_basic_with_address": basic("corporate", address=True),
    "natural_basic_with_address": basic("natural", address=True),
    "corporate_contact_with_address": contact("corporate", *ADDRESS_CONTACTS["corporate"], *PARTY_CONTACTS),
    "natural_contact_with_address": contact("natural", *ADDRESS_CONTACTS["natural"], *PARTY_CONTACTS),
    "natural_basic_two_sources": basic("natural", source="(FROM income UNION ALL FROM income_extra)"),
    "corporate_risk_with_products": risk_with_products("corporate"),
    "natural_risk_with_products": risk_with_products("natural"),
    "corporate_basic_recoded": basic("corporate", recode_industry=True),
    "natural_basic_recoded": basic("natural", recode_industry=True),
    "asof_product_rating": statement(
        "SELECT c.contract_no, c.end_datetime, r.valid_from AS valid_since, r.product_code, r.risk_level "
        "FROM policy c ASOF LEFT JOIN (SELECT DISTINCT ON (contract_no, valid_from) contract_no, valid_from, product_code, "
        "risk_level FROM product_risk WHERE valid_from IS NOT NULL "
        "ORDER BY contract_no, valid_from, product_code DESC, risk_level DESC) r "
        "ON c.contract_no = r.contract_no AND c.end_datetime >= r.valid_from"),
    "recode_industry": statement(
        f"SELECT contract_no, {converted('occu_type1_code', '1')} AS INDUSTRY_TYPE1, "
        f"{converted('occu_type2_code', '2')} AS INDUSTRY_TYPE2 FROM party"),
    "scan_party": statement("FROM party"),
    "project_basic": statement(f"SELECT {columns(PROJECTED)} FROM party m"),
    "audit_stamp": statement(f"SELECT {columns({'ID_NO': WHO['ID_NO']} | stamps())} FROM member m", *members("corporate")),
    "filter_policy_status": statement("FROM policy WHERE policy_status = '7'"),
    "filter_id_type": statement("FROM party SELECT contract_no, customer_id, idntfctn_type WHERE idntfctn_type <> '4'"),
    "policies_in_force": statement("FROM live", live(DAY)),
    "filter_non_blank": statement(f"FROM party SELECT contract_no, customer_id, cellular_phone WHERE {filled('cellular_phone')}"),
    "filter_income_usable": statement(
        "SELECT d.contract_no, p.customer_id, d.pay_source, d.min_year_income, d.change_date_time "
        "FROM income d JOIN party p USING (contract_no) WHERE p.customer_id IS NOT NULL "
        f"AND ({filled('d.pay_source')} OR d.min_year_income IS NOT NULL)"),
    "address_on_date": statement(f"FROM party_address WHERE dbc_business_date::DATE = {quoted(DAY)}::DATE"),
    "join_policy_insured": statement("FROM insured SEMI JOIN live USING (contract_no) SELECT contract_no, customer_id",
                                     live(DAY)),
    "semi_active_customers": statement("FROM party SEMI JOIN active USING (customer_id) "
                                       "SELECT contract_no, customer_id, idntfctn_type", live(DAY), active()),
    "active_customer_ids": statement("FROM active", live(DAY), active()),
    "left_join_income": statement("SELECT customer_id, f.pay_source, f.min_year_income "
                                  "FROM member LEFT JOIN funds f USING (customer_id)", *members("natural"), *declared()),
    "left_join_contract_party": statement("SELECT contract_no, l.agent_id, p.customer_id "
                                          "FROM policy_agent l LEFT JOIN party p USING (contract_no)"),
    "left_join_party_role": statement("SELECT l.contract_no, l.customer_id, p.national_country_code "
                                      "FROM insured l LEFT JOIN party p ON p.customer_id = l.customer_id"),
    "left_join_manager": statement("SELECT m.contract_no, customer_id, idntfctn_type, e.manager_name AS em_manager_name, "
                                   f"e.birthday AS em_birthday, e.national_country_code AS em_country FROM {MANAGED}"),
    "lookup_industry_risk": statement(f"SELECT m.customer_id, m.risk_industry_code, i.data1 FROM {rated()}",
                                      *members("natural"), INDUSTRY),
    "lookup_country_risk": statement(f"SELECT m.customer_id, m.ocr_country_code, k.risk_level FROM {rated()}",
                                     *members("natural"), INDUSTRY),
    "income_profile": statement("FROM funds SELECT customer_id, pay_source, min_year_income", *declared()),
    "agg_pay_source_set": statement("FROM kinds", *declared()),
    "agg_latest_income": statement("FROM newest_amount", *declared()),
    "distinct_contacts": statement("FROM reachable SELECT id AS ID, contact_type AS CONTACT_TYPE, content AS CONTENT",
                                   reachable(*PARTY_CONTACTS)),
    "latest_party": statement(f"SELECT {IDENTITY} FROM ({newest('natural')})"),
    "population_natural": statement(f"SELECT {IDENTITY} FROM member", *members("natural")),
    "population_incremental": statement(f"SELECT {IDENTITY} FROM member", *members("natural")),
    "population_corporate": statement(f"SELECT {IDENTITY} FROM member", *members("corporate")),
    "latest_registered_address": statement("FROM registered", REGISTERED),
    "contact_address_arms": statement("FROM reachable SELECT id AS ID, contact_type AS CONTACT_TYPE, content AS CONTENT",
                                      reachable(*ADDRESS_CONTACTS["natural"])),
    "try_cast_income": statement(f"SELECT contract_no, change_date_time, {txt('pay_source')} AS INVEST_SOURCE, "
                                 f"{txt('min_year_income')} AS ANNUAL_INCOME FROM income"),
    "map_job_title": statement("SELECT contract_no, risk_jobtitle_code, "
                               f"{recode('risk_jobtitle_code', codes.JOB_TITLES)} AS INDUSTRY_TITLE FROM party"),
    "map_pay_source": statement("SELECT contract_no, change_date_time, pay_source, "
                                f"{recode('pay_source', codes.PAY_SOURCES)} AS PAY_SOURCE_TEXT FROM income"),
    "map_risk_level": statement(f"SELECT m.contract_no, {recode('m.risk_level', codes.CUSTOMER_RISK)} AS RISK_LEVEL, "
                                f"{recode('k.risk_level', codes.COUNTRY_RISK)} AS COUNTRY_RISK FROM {rated('party')}", INDUSTRY),
    "map_id_type_gender": statement(f"SELECT m.contract_no, {ID_TYPE} AS ID_TYPE, {GENDER} AS GENDER FROM party m"),
    "bucket_birth_digit": statement(f"SELECT contract_no, birthday, {digit('birthday')} AS PTN FROM party"),
    "flags_default_zero": statement(
        "SELECT m.contract_no, " + ", ".join(f"{e} AS {n}" for n, e in risk_columns("corporate").items()
                                             if e.startswith("ifnull")) + " FROM party m"),
    "manager_name_fallback": statement(f"SELECT m.contract_no, ifnull(e.manager_name, m.manager_name) AS C_FULLNAME FROM {MANAGED}"),
    "arm_agent": arm(agents()),
    "arm_insured": arm(insured_persons(8)),
    "arm_insured_natural": arm(insured_persons(4)),
    "arm_benef_health": arm(health(9)),
    "arm_benef_travel": arm(travel(9)),
    "arm_manager": arm(managers(2), managers(3)),
    "union_relation_arms": arm(*CORPORATE_ARMS),
    "audit_counts": " UNION ALL ".join(f"({counted(n)})" for n in DATASETS),
    "audit_relation_types": counted("corporate_relations", "RELATION_TYPE"),
    "audit_relation_types_natural": counted("natural_relations", "RELATION_TYPE"),
    "publish_roundtrip": DATASETS["natural_contact"],
    "snapshot_merge": first_created(SNAPSHOTS),
    "release_reuse": DATASETS["natural_contact"],
    "release_counts": " UNION ALL ".join(f"(SELECT dataset, records FROM ({counted(n)}))"
                                         for n in ("corporate_contact", "natural_contact")),
}
