"""Hand-made rows for the semantic decisions of SURVEY S1-S17."""

import datetime as dt

from builders import make_sources, party_row, ts
from custmaster.params import RunParams
from custmaster.plans import datasets

AS_OF = RunParams(as_of=dt.date(2001, 6, 1))

ACTIVE = [(100, "7", None)]                     # open-ended in-force policy


def _ins(*ids, contract=100):
    return [(contract, i, f"P{i}", "1970-02-01") for i in ids]


def collect(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_in_force_predicate(spark):
    party = [party_row(1, c) for c in (1, 2, 3, 4, 5)]
    policy = [(100, "7", None), (101, "7", ts("2001-06-01")), (102, "7", ts("2001-05-31")),
              (103, "1", None), (104, "7", ts("2002-01-01 10:00:00"))]
    insured = [(100, 1, "a", None), (101, 2, "b", None), (102, 3, "c", None),
               (103, 4, "d", None), (104, 5, "e", None)]
    src = make_sources(spark, party=party, policy=policy, insured=insured)
    pop = datasets.class_population(src, "natural", AS_OF)
    # open end, end on the business date, end later: in; ended before, wrong status: out
    assert collect(pop, "customer_id") == [(1,), (2,), (5,)]


def test_latest_row_tie_breaks_on_contract(spark):
    party = [party_row(10, 1, when="2000-01-01", customer_name="old"),
             party_row(11, 1, when="2000-05-01", customer_name="tie-low"),
             party_row(12, 1, when="2000-05-01", customer_name="tie-high")]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=_ins(1))
    df = datasets.natural_basic(src, AS_OF)
    assert collect(df, "ID_NO", "C_FULLNAME") == [("1", "tie-high")]


def test_class_filter_before_ranking(spark):
    # newest row is corporate ('4'); the natural dataset still sees the older natural row
    party = [party_row(10, 7, "1", "2000-01-01", customer_name="person"),
             party_row(11, 7, "4", "2001-01-01", customer_name="company")]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=_ins(7))
    nat = datasets.natural_basic(src, AS_OF)
    cor = datasets.corporate_basic(src, AS_OF)
    assert collect(nat, "ID_NO", "C_FULLNAME") == [("7", "person")]
    assert collect(cor, "ID_NO", "C_FULLNAME") == [("7", "company")]


def test_income_profile_set_and_latest(spark):
    party = [party_row(10, 1), party_row(11, 1, when="2000-02-01")]
    income = [
        (10, "2", 100, ts("2000-01-01")),
        (10, "1", 200, ts("2000-03-01")),
        (11, "", 300, ts("2000-02-01")),     # blank source + amount: kept, gives ''
        (11, None, None, ts("2001-01-01")),  # unusable: dropped before the aggregate
        (11, "9", None, ts("1999-01-01")),   # unmapped code passes through
        (99, "3", 999, ts("2002-01-01")),    # unknown contract: no customer
    ]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=_ins(1), income=income)
    df = datasets.natural_basic(src, AS_OF)
    [(source, income_txt)] = collect(df, "INVEST_SOURCE", "ANNUAL_INCOME")
    assert source == ",9,工作/營業收入,投資/業外收入"
    assert income_txt == "200"


def test_latest_income_null_wins(spark):
    # max_by semantics: the value at the latest change time, even when NULL
    party = [party_row(10, 1)]
    income = [(10, "1", 500, ts("2000-01-01")), (10, "2", None, ts("2000-06-01"))]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=_ins(1), income=income)
    [(amount,)] = collect(datasets.corporate_basic(
        make_sources(spark, party=[party_row(10, 1, "4")], policy=ACTIVE, insured=_ins(1),
                     income=income), AS_OF), "PAID_UP_CAPITAL")
    assert amount is None
    [(amount2,)] = collect(datasets.natural_basic(src, AS_OF), "ANNUAL_INCOME")
    assert amount2 is None


def test_customer_without_income_has_nulls(spark):
    src = make_sources(spark, party=[party_row(10, 1)], policy=ACTIVE, insured=_ins(1))
    [(a, b)] = collect(datasets.natural_basic(src, AS_OF), "INVEST_SOURCE", "ANNUAL_INCOME")
    assert a is None and b is None


def test_risk_maps_and_lookups(spark):
    party = [party_row(10, 1, risk_level="30", ocr_country_code=40, risk_industry_code="X",
                       mny_err="1"),
             party_row(11, 2, risk_level="77", ocr_country_code=90, risk_industry_code="Y"),
             party_row(12, 3, risk_level=None, ocr_country_code=25, risk_industry_code="Z"),
             party_row(13, 4, ocr_country_code=5)]
    lookup = [("RISK_INDUSTRY_TYPE", "X", "00"), ("RISK_INDUSTRY_TYPE", "Y", "30"),
              ("OTHER_PARAM", "Z", "00"), ("RISK_INDUSTRY_TYPE", "Z", "20")]
    country = [(40, "40"), (90, "90"), (25, "25")]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=_ins(1, 2, 3, 4),
                       param_lookup=lookup, country_risk=country)
    df = datasets.natural_risk(src, AS_OF)
    got = collect(df, "ID_NO", "RISK_LEVEL", "INDUSTRY_RISK", "COUNTRY_RISK",
                  "IS_PROHIBITEDLIST", "IS_SAN", "IS_CFH_SIP")
    assert got == [
        ("1", "3", "1", "40", "1", "0", "0"),    # '40' passes through (code, not comment)
        ("2", "77", "3", "4", "0", "0", "0"),    # unmapped level passes; '90' -> '4'
        ("3", None, "20", "2", "0", "0", "0"),   # decoy param ignored; '25' -> '2'
        ("4", "1", None, None, "0", "0", "0"),   # lookup misses -> NULL
    ]


def test_contacts_types_blanks_and_ptn(spark):
    party = [party_row(10, 1, cellular_phone="0911", email="a@x", birthday="1987-05-05"),
             party_row(11, 1, cellular_phone="0911", email="", when="1999-01-01"),
             party_row(12, 2, cellular_phone="", email=None, birthday="****-**-**"),
             party_row(13, 3, cellular_phone=None, email="c@x", birthday=None)]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=_ins(1, 2, 3))
    df = datasets.natural_contact(src, AS_OF)
    assert collect(df, "ID_NO", "CONTACT_TYPE", "CONTENT", "PTN") == [
        ("1", "5", "0911", "7"), ("1", "6", "a@x", "7"), ("3", "6", "c@x", "0")]


def test_relations_arms(spark):
    party = [party_row(500, 1, "4", risk_jobtitle_code="T050", manager_id="MX",
                       manager_name="fallback"),
             party_row(501, 1, "4", when="1999-01-01", risk_jobtitle_code="T999",
                       manager_id="MX", manager_name="fallback"),
             party_row(600, 8, "1", national_country_code=33, birthday="1960-01-01")]
    agents = [(500, 77), (500, 77), (999, 55)]          # duplicate; unknown contract
    insured = [(100, 1, "P1", None), (500, 8, "P8", "1960-02-02"), (500, 9, "P9", None)]
    health = [(501, 8, "B8", "2")]
    travel = [(500, "T1", "3"), (999, "T2", "3")]
    em = [("4", 1, None, "1950-01-01", 44)]
    src = make_sources(spark, party=party, policy=ACTIVE, insured=insured,
                       policy_agent=agents, benef_health=health, benef_travel=travel,
                       entity_manager=em)
    df = datasets.corporate_relations(src, AS_OF)
    got = collect(df, "RELATION_TYPE", "C_FULLNAME", "REPRESNT_POS", "RELATION_CODE",
                  "BIRTHDAY_DATE", "RELATION_ID_NO", "COUNTRY")
    assert ("1", None, None, None, None, "77", None) in got
    assert ("8", "P8", None, None, "1960-02-02", "8", "33") in got
    assert ("8", "P9", None, None, None, "9", None) in got
    assert ("9", "B8", None, "2", "1960-01-01", "8", "33") in got
    assert ("9", "T1", None, "3", None, None, None) in got
    # twin manager arms: same rows, tags 2 and 3; title mapped or passed through
    for tag in ("2", "3"):
        assert (tag, "fallback", "企業負責人", None, "1950-01-01", "MX", "44") in got
        assert (tag, "fallback", "T999", None, "1950-01-01", "MX", "44") in got
    assert len(got) == 9
    assert {r["ID_NO"] for r in df.collect()} == {"1"}


def test_second_income_source_is_unioned(spark):
    from builders import SCHEMAS
    from custmaster.sources import Sources
    base = make_sources(spark, party=[party_row(10, 1)], policy=ACTIVE, insured=_ins(1),
                        income=[(10, "1", 100, ts("2000-01-01"))])
    extra = spark.createDataFrame([(10, "3", 900, ts("2000-06-01"))], SCHEMAS["income"])
    loaders = {r: (lambda r=r: getattr(base, r)) for r in SCHEMAS}
    loaders["income_extra"] = lambda: extra
    src = Sources(spark, loaders)
    [(s, a)] = collect(datasets.natural_basic(src, AS_OF), "INVEST_SOURCE", "ANNUAL_INCOME")
    assert s == "工作/營業收入,退休收入" and a == "900"
