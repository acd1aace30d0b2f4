"""Address-table operators (written in the source but switched off there,
waiting for the address table to be loaded): latest registered address per
customer, address/phone contact arms, and the business-date filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.functions import codes
from custmaster.functions.columns import non_blank
from custmaster.operators.population import latest_per_key

# Address kinds of the address table
ADDRESS_KIND_REGISTERED = "1"
ADDRESS_KIND_MAILING = "2"
ADDRESS_KIND_MAIN = "3"


def on_business_date(df: DataFrame, col: str, day: dt.date) -> DataFrame:
    """Rows of one day; as a range of the date-time column it reaches the Parquet scan."""
    return df.filter(F.to_date(col) == F.lit(day))


def latest_registered_address(party_address: DataFrame) -> DataFrame:
    """Latest non-blank registered address (kind '1') per customer.

    Ordered by create date, then by the address text so that equal dates
    give one fixed answer.
    """
    a = (party_address.select("customer_id", "address", "create_date", "address_kind")
         .filter((F.col("address_kind") == ADDRESS_KIND_REGISTERED) & non_blank("address")))
    return latest_per_key(a, ["customer_id"], ["create_date", "address"]).select(
        "customer_id", "address")


def address_contact_rows(party_address: DataFrame, natural: bool,
                         business_date: dt.date | None = None) -> DataFrame:
    """(ID, CONTACT_TYPE, CONTENT) rows from the address table, in one scan.

    Corporate: '1' main address (kind '3'), '2' mailing address (kind '2'),
    '3' phone 1.  Natural persons add '4' phone 2, and the first arm is
    restricted to the business date when one is given.
    """
    a = party_address.select("customer_id", "address_kind", "address", "phone1", "phone2",
                             "dbc_business_date")
    kind = F.col("address_kind")
    first_ok = kind == ADDRESS_KIND_MAIN
    if natural and business_date is not None:
        first_ok = first_ok & (F.to_date("dbc_business_date") == F.lit(business_date))
    arms = [
        F.struct(F.lit(codes.CONTACT_ADDRESS_MAIN).alias("t"), F.col("address").alias("c"),
                 first_ok.alias("ok")),
        F.struct(F.lit(codes.CONTACT_ADDRESS_MAIL).alias("t"), F.col("address").alias("c"),
                 (kind == ADDRESS_KIND_MAILING).alias("ok")),
        F.struct(F.lit(codes.CONTACT_PHONE1).alias("t"), F.col("phone1").alias("c"),
                 F.lit(True).alias("ok")),
    ]
    if natural:
        arms.append(F.struct(F.lit(codes.CONTACT_PHONE2).alias("t"), F.col("phone2").alias("c"),
                             F.lit(True).alias("ok")))
    x = a.select(F.col("customer_id").alias("ID"), F.explode(F.array(*arms)).alias("x"))
    return (x.filter(F.col("x.ok") & non_blank(F.col("x.c")))
            .select("ID", F.col("x.t").alias("CONTACT_TYPE"), F.col("x.c").alias("CONTENT")))
