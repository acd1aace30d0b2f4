"""Risk-rating datasets (corporate and natural persons).

Population ⟕ industry-risk parameters ⟕ country-risk table.  The lookups are
joined without a hint: Spark broadcasts one whose size in bytes is below
``spark.sql.autoBroadcastJoinThreshold`` (or turns out to be, at run time) and
shuffles a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.functions import codes
from custmaster.functions.columns import blank, flag_or_zero, stamp, text
from custmaster.operators.asof import as_of_join
from custmaster.params import RunParams


def industry_risk_lookup(param_lookup: DataFrame, params: RunParams
                         ) -> DataFrame:
    return (param_lookup.filter(F.col("param_id") == params.industry_param)
            .select(F.col("display_value").alias("_ind_value"), F.col("data1").alias("_ind_data1")))


def country_risk_lookup(country_risk: DataFrame) -> DataFrame:
    return country_risk.select(F.col("country_code").alias("_cty_code"),
                               F.col("risk_level").alias("_cty_level"))


def with_risk_lookups(pop: DataFrame, param_lookup: DataFrame, country_risk: DataFrame,
                      params: RunParams) -> DataFrame:
    """Population plus ``_ind_data1`` (industry) and ``_cty_level`` (country of OCR code)."""
    ind = industry_risk_lookup(param_lookup, params)
    cty = country_risk_lookup(country_risk)
    j = pop.join(ind, pop["risk_industry_code"] == ind["_ind_value"], "left")
    return j.join(cty, j["ocr_country_code"] == cty["_cty_code"], "left")


def contract_product_ratings(product_risk: DataFrame, contracts: DataFrame, at: Column) -> DataFrame:
    """(contract_no, product_code, valid_since, risk_level): each product of the given contracts
    (contract_no), as rated at the time ``at``; nulls before the first rating.  Ratings of other
    contracts go before the as-of join, which copies its right side to every salt."""
    rated = product_risk.join(contracts.select("contract_no"), "contract_no", "left_semi")
    held = rated.select("contract_no", "product_code").where("product_code IS NOT NULL").distinct().withColumn("at", at)
    return as_of_join(held, rated, ["contract_no", "product_code"], "at", "valid_from",
                      ["risk_level"]).drop("at")


def product_ratings(product_risk: DataFrame, bridge: DataFrame, contracts: DataFrame, params: RunParams) -> DataFrame:
    """(customer_id, _prod_types, _prod_risk): the products of a customer's contracts in force that are
    rated on the business date, and the highest of their ratings (coded like country risk).

    ``bridge``: (contract_no, customer_id) pairs of the customers that matter; ``contracts``: those in force."""
    wanted = bridge.select("contract_no").distinct().join(contracts.select("contract_no"), "contract_no", "left_semi")
    rated = contract_product_ratings(product_risk, wanted, F.lit(params.as_of).cast("timestamp_ntz"))
    rated = rated.where("valid_since IS NOT NULL")
    return rated.join(bridge.select("contract_no", "customer_id"), "contract_no").groupBy("customer_id").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("product_code"))).alias("_prod_types"),
        F.max(text(codes.country_risk(F.col("risk_level")))).alias("_prod_risk"))


def risk_columns(params: RunParams, products: bool = False) -> list:
    def product(col: str) -> Column:
        return F.coalesce(F.col(col), blank()) if products else blank()

    return [
        text("customer_id").alias("ID_NO"),
        F.lit(params.source_tag).alias("SOURCE"),
        text(codes.customer_risk(F.col("risk_level"))).alias("RISK_LEVEL"),
        text("risk_level_update").alias("RISK_MODIFY_DATE"),
        F.lit("0").alias("IS_CFH_PROHIBITEDLIST"),
        F.lit("0").alias("IS_CFH_SIP"),
        flag_or_zero(F.col("san")).alias("IS_SAN"),
        flag_or_zero(F.col("mny_err")).alias("IS_PROHIBITEDLIST"),
        flag_or_zero(F.col("sip")).alias("IS_SIP"),
        flag_or_zero(F.col("am")).alias("IS_AME"),
        flag_or_zero(F.col("pep")).alias("IS_PEP"),
        flag_or_zero(F.col("rca")).alias("IS_RCA"),
        text(codes.industry_risk(F.col("_ind_data1"))).alias("INDUSTRY_RISK"),
        product("_prod_types").alias("PROD_CXL_APC"),
        product("_prod_risk").alias("PROD_RISK_CXL_APC"),
        text(codes.country_risk(F.col("_cty_level"))).alias("COUNTRY_RISK"),
        stamp(params.as_of).alias("LAST_MODIFIED_DATE"),
        stamp(params.create_date).alias("CREATE_DATE"),
    ]


def _rated(pop: DataFrame, param_lookup: DataFrame, country_risk: DataFrame, params: RunParams,
           products: DataFrame | None) -> DataFrame:
    j = with_risk_lookups(pop, param_lookup, country_risk, params)
    return j if products is None else j.join(products, "customer_id", "left")


def corporate_risk(pop: DataFrame, param_lookup: DataFrame, country_risk: DataFrame,
                   params: RunParams, products: DataFrame | None = None) -> DataFrame:
    """``products`` (``product_ratings``) fills the product columns; without it they are ``''`` as in the source."""
    return _rated(pop, param_lookup, country_risk, params, products).select(
        *risk_columns(params, products is not None))


def natural_risk(pop: DataFrame, param_lookup: DataFrame, country_risk: DataFrame,
                 params: RunParams, products: DataFrame | None = None) -> DataFrame:
    return _rated(pop, param_lookup, country_risk, params, products).select(
        text(codes.id_type(F.col("idntfctn_type"))).alias("ID_TYPE"), *risk_columns(params, products is not None))
