"""Basic-profile datasets: population ⟕ income profile, then the select list.

The income profile is computed only for the population's customers (its
bridge is restricted by a semi-join), so the left join is 1:1 on customer_id
and both sides arrive hash-partitioned on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.functions import codes
from custmaster.functions.columns import blank, stamp, text
from custmaster.operators.income import contract_customer_bridge, income_profile
from custmaster.params import RunParams


def with_income(pop: DataFrame, party: DataFrame, income: DataFrame,
                restrict_ids: DataFrame | None = None, pairs: DataFrame | None = None
                ) -> DataFrame:
    """Population ⟕ income profile.

    The profile is computed only for ``restrict_ids`` (default: the
    population's ids).  Any superset of the population gives the same rows;
    passing the active-customer ids avoids ranking the party history a second
    time when the population is not materialised.
    """
    ids = restrict_ids if restrict_ids is not None else pop.select("customer_id")
    prof = income_profile(income, contract_customer_bridge(party, ids, pairs=pairs))
    prof = prof.select("customer_id", F.col("pay_source").alias("_inc_source"),
                       F.col("min_year_income").alias("_inc_amount"))
    return pop.join(prof, "customer_id", "left")


def _with_address(df: DataFrame, address: DataFrame) -> DataFrame:
    return df.join(address.select("customer_id", F.col("address").alias("_reg_addr")),
                   "customer_id", "left")


def corporate_basic(pop: DataFrame, party: DataFrame, income: DataFrame,
                    params: RunParams,
                    registered_address: DataFrame | None = None,
                    restrict_ids: DataFrame | None = None,
                    pairs: DataFrame | None = None) -> DataFrame:
    """Corporate basic profile.  ``registered_address`` (customer_id, address)
    fills REGISTERED_ADDR; without it the column is ``''`` as in the source."""
    df = with_income(pop, party, income, restrict_ids, pairs)
    reg = blank()
    if registered_address is not None:
        df = _with_address(df, registered_address)
        reg = text("_reg_addr")
    return df.select(
        text("customer_id").alias("ID_NO"),
        F.lit(params.source_tag).alias("SOURCE"),
        text("customer_name").alias("C_FULLNAME"),
        blank().alias("E_FULLNAME"),
        text("entity_settime").alias("BUILD_DATE"),
        text("entity_reg_ctycode").alias("COUNTRY"),
        reg.alias("REGISTERED_ADDR"),
        text("occu_type1_code").alias("INDUSTRY_TYPE1"),
        text("occu_type3_code").alias("INDUSTRY_TYPE2"),
        blank().alias("ESTATE_SOURCE"),
        F.col("_inc_source").try_cast("string").alias("INVEST_SOURCE"),
        blank().alias("YEAR_PROFIT"),
        F.col("_inc_amount").try_cast("string").alias("PAID_UP_CAPITAL"),
        blank().alias("PRODUCT_CUB"),
        blank().alias("OWNER_STRUCT"),
        text("bearer_shares_status").alias("IS_BEARER_SHARES"),
        blank().alias("IS_HIDE_OWNER"),
        stamp(params.as_of).alias("LAST_MODIFIED_DATE"),
        stamp(params.create_date).alias("CREATE_DATE"),
    )


def natural_basic(pop: DataFrame, party: DataFrame, income: DataFrame,
                  params: RunParams,
                  registered_address: DataFrame | None = None,
                  restrict_ids: DataFrame | None = None,
                  pairs: DataFrame | None = None) -> DataFrame:
    """Natural-person basic profile.  With ``registered_address`` a
    REGISTERED_ADDR column follows COUNTRY (it is commented out in the source)."""
    df = with_income(pop, party, income, restrict_ids, pairs)
    addr = []
    if registered_address is not None:
        df = _with_address(df, registered_address)
        addr = [text("_reg_addr").alias("REGISTERED_ADDR")]
    return df.select(
        text(codes.id_type(F.col("idntfctn_type"))).alias("ID_TYPE"),
        text("customer_id").alias("ID_NO"),
        F.lit(params.source_tag).alias("SOURCE"),
        text("customer_name").alias("C_FULLNAME"),
        blank().alias("E_FULLNAME"),
        text(codes.gender(F.col("sex"))).alias("GENDER"),
        text("birthday").alias("BIRTHDAY_DATE"),
        blank().alias("EXPIRED_DATE"),
        blank().alias("PASSPORT_NUMBER"),
        blank().alias("PASSPORT_VALIDITY"),
        text("national_country_code").alias("COUNTRY"),
        *addr,
        blank().alias("O_NAME"),
        blank().alias("EDUCATION_CODE"),
        text("occu_type1_code").alias("INDUSTRY_TYPE1"),
        text("occu_type2_code").alias("INDUSTRY_TYPE2"),
        blank().alias("SERVICES"),
        codes.job_title(F.col("risk_jobtitle_code")).alias("INDUSTRY_TITLE"),
        F.col("_inc_source").try_cast("string").alias("INVEST_SOURCE"),
        blank().alias("ESTATE_SOURCE"),
        F.col("_inc_amount").try_cast("string").alias("ANNUAL_INCOME"),
        blank().alias("PRODUCT_CUB"),
        stamp(params.as_of).alias("LAST_MODIFIED_DATE"),
        stamp(params.create_date).alias("CREATE_DATE"),
    )
