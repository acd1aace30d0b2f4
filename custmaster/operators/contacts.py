"""Contact-point datasets.

The source unions two filtered scans of the party history (mobile phone as
type '5', e-mail as type '6') and takes ``DISTINCT``.  Here it is one scan:
each row is exploded into its two (type, content) pairs, blanks are
dropped, and the distinct runs as a partial + final aggregate, so repeated
history rows of one customer collapse map-side before any shuffle.  The
result is joined once to the population.  The history is restricted to the
population's customers before that (``ids``, salted): rows of nobody's interest
end at the scan's join instead of being made distinct.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.functions import codes
from custmaster.functions.columns import birth_digit, non_blank, stamp, text
from custmaster.operators.address import address_contact_rows
from custmaster.operators.population import for_customers
from custmaster.params import RunParams


def party_contact_rows(party: DataFrame) -> DataFrame:
    """(ID, CONTACT_TYPE, CONTENT) of every non-blank phone / e-mail, with duplicates."""
    pairs = F.array(
        F.struct(F.lit(codes.CONTACT_MOBILE).alias("t"), F.col("cellular_phone").alias("c")),
        F.struct(F.lit(codes.CONTACT_EMAIL).alias("t"), F.col("email").alias("c")),
    )
    x = party.select(F.col("customer_id").alias("ID"), F.explode(pairs).alias("x"))
    return (x.filter(non_blank(F.col("x.c")))
            .select("ID", F.col("x.t").alias("CONTACT_TYPE"), F.col("x.c").alias("CONTENT")))


def distinct_contacts(party: DataFrame, party_address: DataFrame | None = None,
                      natural: bool = False, business_date: dt.date | None = None,
                      party_contacts: DataFrame | None = None, customers: DataFrame | None = None) -> DataFrame:
    """``SELECT DISTINCT ID, CONTACT_TYPE, CONTENT`` over all contact arms.

    ``party_contacts`` is an already computed distinct of the party arms (the
    daily batch materialises it once for both classes).  ``customers``
    (customer_id, once each) restricts the history before its contacts are made distinct."""
    if customers is not None and party_contacts is None:
        party = for_customers(party.select("contract_no", "customer_id", "cellular_phone", "email"), customers)
    if party_contacts is not None:
        if party_address is None:
            return party_contacts
        rows = party_contacts
    else:
        rows = party_contact_rows(party)
    if party_address is not None:
        rows = address_contact_rows(party_address, natural, business_date).unionByName(rows)
    return rows.distinct()


def _joined(pop: DataFrame, contacts: DataFrame) -> DataFrame:
    return pop.join(contacts, pop["customer_id"] == contacts["ID"], "inner")


def corporate_contact(pop: DataFrame, party: DataFrame, params: RunParams,
                      party_address: DataFrame | None = None,
                      party_contacts: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    j = _joined(pop, distinct_contacts(party, party_address, natural=False,
                                       party_contacts=party_contacts, customers=ids))
    return j.select(
        text("customer_id").alias("ID_NO"),
        F.lit(params.source_tag).alias("SOURCE"),
        text("entity_head_ctycode").alias("COUNTRY"),
        text("CONTACT_TYPE").alias("CONTACT_TYPE"),
        text("CONTENT").alias("CONTENT"),
        F.lit("1").alias("STATUS"),
        stamp(params.as_of).alias("LAST_MODIFIED_DATE"),
        stamp(params.create_date).alias("CREATE_DATE"),
    )


def natural_contact(pop: DataFrame, party: DataFrame, params: RunParams,
                    party_address: DataFrame | None = None,
                    party_contacts: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    j = _joined(pop, distinct_contacts(party, party_address, natural=True,
                                       business_date=params.as_of,
                                       party_contacts=party_contacts, customers=ids))
    return j.select(
        text(codes.id_type(F.col("idntfctn_type"))).alias("ID_TYPE"),
        text("customer_id").alias("ID_NO"),
        F.lit(params.source_tag).alias("SOURCE"),
        text("ocr_country_code").alias("COUNTRY"),
        text("CONTACT_TYPE").alias("CONTACT_TYPE"),
        text("CONTENT").alias("CONTENT"),
        F.lit("1").alias("STATUS"),
        stamp(params.as_of).alias("LAST_MODIFIED_DATE"),
        stamp(params.create_date).alias("CREATE_DATE"),
        birth_digit(F.col("birthday")).alias("PTN"),
    )
