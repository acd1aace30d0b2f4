"""Fixture adapters: the driver's TPC-H-like tables projected into the shapes
of the insurance source tables (party history, policy, link tables, lookups).

DataFrame code, one function per source table; every function reads only
the columns it needs, so the Parquet scans are pruned.  NULLs, blanks and
orphan contracts are made by modular rules on the keys (the driver data has
none), exactly as the SQL text in ``fixture_sql`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

S = "string"


def _s(c: Column) -> Column:
    return c.cast(S)


def _orphan(key: Column, residue: int) -> Column:
    """Every 20th contract of a link table points to a contract that does not exist."""
    return F.when(key % 20 == residue, F.lit(-1) - key).otherwise(key)


def _year_text(key: Column, suffix: str) -> Column:
    return F.concat(F.lit("19"), _s(F.lit(20) + key % 80), F.lit(suffix))


class DriverTables:
    """Reads the driver's parquet tables from one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select(*cols) if cols else df


def party(t: DriverTables) -> DataFrame:
    """Every attribute varies between a customer's history rows; some rows have no customer."""
    o = t.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = t.read("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    ck, ok = F.col("c_custkey"), F.col("o_orderkey")
    nk, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    mix = ck + ok
    none = F.lit(None).cast(S)

    def flag(m: int) -> Column:
        return F.when(mix % m == 0, F.lit("1")).otherwise(none)

    trade = F.when(ok % 6 == 0, F.lit("BUILDING")).otherwise(seg)
    return o.join(c, F.col("o_custkey") == ck).select(
        ok.alias("contract_no"),
        F.when(ok % 23 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when((ck % 11 == 0) & (ok % 2 == 0), F.lit("4"))
         .otherwise(_s(F.lit(1) + ck % 4)).alias("idntfctn_type"),
        F.concat(F.col("c_name"), F.lit(" "), _s(ok % 3)).alias("customer_name"),
        F.col("o_orderdate").alias("change_date_time"),
        F.when(mix % 3 == 0, F.lit("M")).when(mix % 3 == 1, F.lit("F")).otherwise(none).alias("sex"),
        F.when(mix % 9 == 0, F.lit("****-**-**")).when(mix % 9 == 1, none)
         .otherwise(_year_text(ck + ok % 3, "-01-15")).alias("birthday"),
        F.when(mix % 5 == 0, F.lit(None).cast("int")).otherwise((nk + ok % 2) % 25).cast("int")
         .alias("national_country_code"),
        F.when(mix % 8 == 0, F.lit(None).cast("bigint")).otherwise((nk + mix) % 27).alias("ocr_country_code"),
        ((nk + ok) % 25).alias("entity_reg_ctycode"),
        ((nk + ok + 1) % 25).alias("entity_head_ctycode"),
        _s(F.lit(1950) + mix % 70).alias("entity_settime"),
        trade.alias("occu_type1_code"),
        F.concat(seg, F.lit("-"), _s(mix % 10)).alias("occu_type2_code"),
        F.concat(seg, F.lit("-"), _s(mix % 30)).alias("occu_type3_code"),
        _s(ok % 2).alias("bearer_shares_status"),
        F.when(mix % 13 == 0, none)
         .otherwise(F.concat(F.lit("T"), F.lpad(_s((mix % 13) * 10), 3, "0"))).alias("risk_jobtitle_code"),
        F.when(ok % 4 == 0, none).otherwise(F.concat(F.lit("M"), _s(mix % 97))).alias("manager_id"),
        F.when(ok % 4 == 0, none).otherwise(F.concat(F.lit("Mgr "), _s(mix % 97))).alias("manager_name"),
        F.when(mix % 7 == 0, F.lit("")).when(mix % 7 == 1, none)
         .otherwise(F.concat(F.lit("09"), _s(ck), F.lit("-"), _s(ok % 3))).alias("cellular_phone"),
        F.when(mix % 6 == 0, none).when(mix % 6 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("u"), _s(ok % 2), F.lit("@"), _s(ck))).alias("email"),
        F.when(mix % 4 == 0, F.lit("00")).when(mix % 4 == 1, F.lit("30"))
         .when(mix % 4 == 2, F.lit("10")).otherwise(none).alias("risk_level"),
        F.col("o_orderdate").alias("risk_level_update"),
        flag(18).alias("san"),
        flag(10).alias("mny_err"),
        flag(12).alias("sip"),
        flag(14).alias("am"),
        flag(15).alias("pep"),
        flag(16).alias("rca"),
        trade.alias("risk_industry_code"),
    )


def policy(t: DriverTables) -> DataFrame:
    o = t.read("orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    ok = F.col("o_orderkey")
    return o.select(
        ok.alias("contract_no"),
        F.when(F.col("o_orderstatus") == "F", F.lit("7"))
         .otherwise(F.col("o_orderstatus")).alias("policy_status"),
        F.when(ok % 50 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("o_orderdate")).alias("end_datetime"),
    )


def policy_agent(t: DriverTables) -> DataFrame:
    li = t.read("lineitem", "l_orderkey", "l_suppkey")
    return li.select(_orphan(F.col("l_orderkey"), 0).alias("contract_no"),
                     F.col("l_suppkey").alias("agent_id"))


def insured(t: DriverTables) -> DataFrame:
    li = t.read("lineitem", "l_orderkey", "l_partkey")
    pk = F.col("l_partkey")
    return li.select(
        _orphan(F.col("l_orderkey"), 1).alias("contract_no"),
        pk.alias("customer_id"),
        F.concat(F.lit("P"), _s(pk)).alias("customer_name"),
        F.when(pk % 9 == 0, F.lit(None).cast(S)).otherwise(_year_text(pk, "-02-01")).alias("birthday"),
    )


def benef_health(t: DriverTables) -> DataFrame:
    li = t.read("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    pk = F.col("l_partkey")
    return li.filter(F.col("l_returnflag") == "R").select(
        _orphan(F.col("l_orderkey"), 2).alias("contract_no"),
        pk.alias("assured_id"),
        F.concat(F.lit("B"), _s(pk)).alias("assured_name"),
        _s(F.col("l_linenumber")).alias("relative_to_insured"),
    )


def benef_travel(t: DriverTables) -> DataFrame:
    li = t.read("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    return li.filter(F.col("l_returnflag") == "A").select(
        _orphan(F.col("l_orderkey"), 3).alias("contract_no"),
        F.concat(F.lit("B"), _s(F.col("l_partkey"))).alias("assured_name"),
        _s(F.col("l_linenumber")).alias("relative_to_insured"),
    )


def income(t: DriverTables) -> DataFrame:
    """Declarations; those of every 17th customer are of contracts that do not exist."""
    li = t.read("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = t.read("orders", "o_orderkey", "o_custkey")
    code = (F.col("l_partkey") + F.col("l_linenumber")) % 10
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("o_custkey") % 17 == 0, F.lit(-1) - F.col("l_orderkey"))
         .otherwise(_orphan(F.col("l_orderkey"), 4)).alias("contract_no"),
        F.when((F.col("o_custkey") % 17 == 1) | (code == 0), F.lit(None).cast(S))
         .when(code == 9, F.lit("")).otherwise(_s(code)).alias("pay_source"),
        F.when(F.col("l_quantity") < 10, F.lit(None).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint") * 10000).alias("min_year_income"),
        F.col("l_shipdate").alias("change_date_time"),
    )


def income_extra(t: DriverTables) -> DataFrame:
    """A second source of declarations, one per contract (used where it is asked for)."""
    o = t.read("orders", "o_orderkey", "o_totalprice", "o_orderdate")
    ok = F.col("o_orderkey")
    return o.select(
        _orphan(ok, 5).alias("contract_no"),
        F.when(ok % 8 == 0, F.lit("")).otherwise(_s(ok % 8)).alias("pay_source"),
        F.floor("o_totalprice").cast("bigint").alias("min_year_income"),
        F.col("o_orderdate").alias("change_date_time"),
    )


def entity_manager(t: DriverTables) -> DataFrame:
    """Managers of customers, two for every 4th; every 3rd one's customer does not exist."""
    c = t.read("customer", "c_custkey", "c_nationkey")
    ck = F.col("c_custkey")

    def rows(title: str, month: str) -> DataFrame:
        return c.select(
            _s(F.lit(1) + ck % 4).alias("idntfctn_type"),
            F.when(ck % 3 == 1, -ck).otherwise(ck).alias("customer_id"),
            F.when(ck % 5 == 0, F.lit(None).cast(S))
             .otherwise(F.concat(F.lit(title), _s(ck))).alias("manager_name"),
            _year_text(ck, f"-{month}-01").alias("birthday"),
            F.col("c_nationkey").alias("national_country_code"))

    return rows("Boss ", "03").unionByName(rows("Deputy ", "04").filter(F.col("customer_id") % 4 == 0))


def param_lookup(t: DriverTables) -> DataFrame:
    seg = t.read("customer", "c_mktsegment").distinct()
    industry = seg.select(
        F.lit("RISK_INDUSTRY_TYPE").alias("param_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("NO SUCH TRADE"))
         .otherwise(F.col("c_mktsegment")).alias("display_value"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("00"))
         .when(F.col("c_mktsegment") == "BUILDING", F.lit("30"))
         .otherwise(F.lit("10")).alias("data1"))
    decoy = seg.select(F.lit("OTHER_PARAM").alias("param_id"),
                       F.col("c_mktsegment").alias("display_value"),
                       F.lit("99").alias("data1"))
    return industry.unionByName(decoy)


def country_risk(t: DriverTables) -> DataFrame:
    n = t.read("nation", "n_nationkey", "n_regionkey")
    nk, rk = F.col("n_nationkey"), F.col("n_regionkey")
    return n.select(
        nk.alias("country_code"),
        F.when(nk % 7 == 6, F.lit("40")).when(rk == 0, F.lit("10")).when(rk == 1, F.lit("20"))
         .when(rk == 2, F.lit("25")).when(rk == 3, F.lit("30")).otherwise(F.lit("90"))
         .alias("risk_level"),
    )


def party_address(t: DriverTables) -> DataFrame:
    o = t.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        ck.alias("customer_id"),
        _s(F.lit(1) + ok % 3).alias("address_kind"),
        F.when(ok % 6 == 0, F.lit("")).when(ok % 6 == 1, F.lit(None).cast(S))
         .otherwise(F.concat(F.lit("No."), _s(ok), F.lit(" Road"))).alias("address"),
        F.when(ok % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("02"), _s(ck))).alias("phone1"),
        F.when(ok % 5 == 1, F.lit(None).cast(S))
         .otherwise(F.concat(F.lit("03"), _s(ck))).alias("phone2"),
        F.col("o_orderdate").alias("create_date"),
        F.col("o_orderdate").alias("dbc_business_date"),
    )


def product_risk(t: DriverTables) -> DataFrame:
    """Products of a contract, rated several times; some ratings have no date, some dates two ratings."""
    li = t.read("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    rating = (F.when(pk % 6 == 0, F.lit("10")).when(pk % 6 == 1, F.lit("20")).when(pk % 6 == 2, F.lit("25"))
              .when(pk % 6 == 3, F.lit("30")).when(pk % 6 == 4, F.lit("90")).otherwise(F.lit("40")))
    return li.select(
        _orphan(F.col("l_orderkey"), 6).alias("contract_no"),
        F.concat(F.lit("PR"), _s((F.col("l_suppkey") + F.col("l_orderkey")) % 3)).alias("product_code"),
        rating.alias("risk_level"),
        F.when(pk % 29 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")).alias("valid_from"))


def industry_codes(t: DriverTables) -> DataFrame:
    """Two-digit major and seven-digit minor codes: some trades have none, some changed theirs."""
    seg = t.read("customer", "c_mktsegment").distinct()
    s = F.col("c_mktsegment")
    none = F.lit(None).cast("timestamp_ntz")

    def day(text: str) -> Column:
        return F.lit(text).cast("timestamp_ntz")

    def rows(kind: str, source: Column, target: Column, since: Column, until: Column) -> DataFrame:
        return seg.select(F.lit(kind).alias("code_type"), source.alias("source_code"), target.alias("target_code"),
                          since.alias("valid_from"), until.alias("valid_to"), s.alias("_seg"))

    size = _s(F.length(s))
    major = rows("1", s, F.lpad(size, 2, "0"), none, F.when(s == "MACHINERY", day("2001-05-31")))
    later = rows("1", s, F.concat(F.lit("9"), F.substring(size, 1, 1)), day("2001-06-01"), none).filter(s == "MACHINERY")
    ended = rows("1", s, F.lit("99"), none, day("2001-05-31")).filter(s == "FURNITURE")
    n = F.explode(F.sequence(F.lit(0), F.lit(24)))
    minor = seg.select(s, n.alias("n")).select(
        F.lit("2").alias("code_type"), F.concat(s, F.lit("-"), _s(F.col("n"))).alias("source_code"),
        F.concat(F.lpad(_s(F.length(s)), 2, "0"), F.lpad(_s(F.col("n")), 5, "0")).alias("target_code"),
        day("1990-01-01").alias("valid_from"), none.alias("valid_to"))
    return (major.filter(s != "FURNITURE").unionByName(later).unionByName(ended).drop("_seg").unionByName(minor))


ADAPTER_FUNCS = {
    "party": party,
    "policy": policy,
    "policy_agent": policy_agent,
    "insured": insured,
    "benef_health": benef_health,
    "benef_travel": benef_travel,
    "income": income,
    "income_extra": income_extra,
    "entity_manager": entity_manager,
    "param_lookup": param_lookup,
    "country_risk": country_risk,
    "party_address": party_address,
    "product_risk": product_risk,
    "industry_codes": industry_codes,
}
