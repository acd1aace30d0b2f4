"""Funds-source and income profile per customer.

income declarations ⋈ (contract → customer) bridge, usable rows only, then one
group per customer with

* the set of pay-source texts (sorted, comma-joined: the set order of the
  source is undefined, SURVEY S3), and
* the income of the latest declaration (``max_by`` on change time, with the
  contract number and the amount as tie-breakers, SURVEY S8).

The bridge is the *distinct* (contract, customer) pairs of the party history
instead of the history itself: set and latest-value aggregates ignore the
duplicates the history would add, and the join then fans out by the number
of customers per contract, not by the number of history rows.  Both
aggregates are partial + final, so a customer with a huge number of
declarations is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.functions.codes import pay_source_text
from custmaster.functions.columns import usable_income
from custmaster.operators.population import for_customers


def contract_pairs(party: DataFrame, keep_null: bool = False) -> DataFrame:
    """Distinct (contract_no, customer_id) of the party history."""
    b = party.select("contract_no", "customer_id")
    if not keep_null:
        b = b.filter(F.col("customer_id").isNotNull())
    return b.distinct()


def contract_customer_bridge(party: DataFrame, customers: DataFrame | None = None,
                             keep_null: bool = False, pairs: DataFrame | None = None) -> DataFrame:
    """Distinct (contract_no, customer_id) pairs of the party history.

    ``customers`` (one row per customer: ``customer_id`` + columns) restricts
    the history *before* the pairs are made distinct, so only rows of these
    customers are shuffled for it, and its columns are carried along.
    ``keep_null`` keeps party rows without a customer id (the source's left
    joins then yield a NULL id for them, as for an unknown contract).
    ``pairs`` is an already computed ``contract_pairs`` (the daily batch
    materialises it once for four datasets).
    """
    if customers is None:
        return pairs if pairs is not None else contract_pairs(party, keep_null)
    if pairs is not None:
        return for_customers(pairs, customers)
    return for_customers(party.select("contract_no", "customer_id"), customers).distinct()


def usable_declarations(income: DataFrame) -> DataFrame:
    return income.filter(usable_income(F.col("pay_source"), F.col("min_year_income")))


def income_profile(income: DataFrame, bridge: DataFrame) -> DataFrame:
    """customer_id, pay_source (text set), min_year_income (latest)."""
    j = (usable_declarations(income)
         .select("contract_no", "pay_source", "min_year_income", "change_date_time")
         .join(bridge.select("contract_no", "customer_id"), "contract_no", "inner"))
    ts = F.col("change_date_time")
    latest_key = F.when(ts.isNotNull(),
                        F.struct(ts, F.col("contract_no"), F.col("min_year_income")))
    return j.groupBy("customer_id").agg(
        F.concat_ws(",", F.array_sort(F.collect_set(pay_source_text(F.col("pay_source")))))
         .alias("pay_source"),
        F.max_by(F.col("min_year_income"), latest_key).alias("min_year_income"),
    )
