"""The population of a dataset: the latest party record of every customer of
one class who is insured on a policy in force on the business date.

Plan shape (checked with ``explain``):

* ``latest_per_key`` is ``row_number() = 1``; Spark turns it into a partial
  ``WindowGroupLimit`` *before* the shuffle and a final one after, so a
  customer with millions of history rows sends at most one row per map task
  through the exchange -- a hot customer cannot pile up in one reducer.
* The ranking runs before the membership test.  The membership test is an
  inner join with the *distinct* active ids (same rows as ``IN (subquery)``):
  a left-semi join would be pushed below the window by Catalyst and then the
  whole party history would be shuffled instead of the pre-limited rows.
* The active ids are a partial + final hash aggregate: duplicates collapse
  map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custmaster.functions.columns import in_force
from custmaster.params import RunParams

# Tie-breaker after the change time: equal change times would otherwise make
# the pick arbitrary.
PARTY_ORDER = ("change_date_time", "contract_no")


def policies_in_force(policy: DataFrame, params: RunParams) -> DataFrame:
    """Contracts with the in-force status whose end is on/after ``as_of`` or open."""
    return (policy
            .filter((F.col("policy_status") == params.policy_status)
                    & in_force(F.col("end_datetime"), params.as_of))
            .select("contract_no"))


def insured_on_policies(policy: DataFrame, insured: DataFrame,
                        params: RunParams) -> DataFrame:
    """policy ⋈ insured on contract, in-force policies only (one row per match)."""
    return (insured.select("contract_no", "customer_id")
            .join(policies_in_force(policy, params), "contract_no", "inner"))


def active_customer_ids(policy: DataFrame, insured: DataFrame,
                        params: RunParams) -> DataFrame:
    """Distinct ids insured on an in-force policy."""
    return (insured_on_policies(policy, insured, params)
            .select("customer_id")
            .filter(F.col("customer_id").isNotNull())
            .distinct())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   rank_col: str | None = None) -> DataFrame:
    """Keep the first row of each key group by ``order`` (strings mean DESC).

    ``row_number`` + ``= 1``: Spark plans it as partial/final WindowGroupLimit.
    """
    ordering = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    rn = rank_col or "_rn"
    ranked = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1)
    return ranked if rank_col else ranked.drop(rn)


def latest_party(party: DataFrame, id_types: Sequence[str]) -> DataFrame:
    """Latest record per customer among the rows of the given classes.

    The class filter is applied before the ranking, as in the source, so one
    customer can be in both classes (SURVEY S9).
    """
    return latest_per_key(party.filter(F.col("idntfctn_type").isin(*id_types)),
                          ["customer_id"], PARTY_ORDER)


def population(party: DataFrame, policy: DataFrame, insured: DataFrame,
               id_types: Sequence[str], params: RunParams) -> DataFrame:
    """Latest party row of each active customer of the class (one row per id)."""
    ids = active_customer_ids(policy, insured, params)
    return latest_party(party, id_types).join(ids, "customer_id", "inner")


def populations_by_class(party: DataFrame, policy: DataFrame, insured: DataFrame,
                         classes: dict[str, Sequence[str]],
                         params: RunParams, class_col: str = "_class"
                         ) -> DataFrame:
    """All classes' populations from one pass over the party history.

    Each row is tagged with its class (``classes``: name -> id types; the
    classes must not share an id type) and ranked within (customer, class):
    the same rows as ``population`` per class, but the history is scanned and
    sorted once instead of once per class.
    """
    tag = None
    for name, types in classes.items():
        cond = F.col("idntfctn_type").isin(*types)
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    tagged = party.withColumn(class_col, tag).filter(F.col(class_col).isNotNull())
    latest = latest_per_key(tagged, ["customer_id", class_col], PARTY_ORDER)
    return latest.join(active_customer_ids(policy, insured, params), "customer_id", "inner")


# A customer's rows meet the customer's one row in this many places.
CUSTOMER_SALTS = 8


def for_customers(rows: DataFrame, customers: DataFrame, salt_by: str = "contract_no",
                  salts: int = CUSTOMER_SALTS) -> DataFrame:
    """``rows`` of the given customers, with the customers' columns (one row a customer).

    The join is on (customer, salt), the salt a hash of ``salt_by``: rows of a
    customer who holds a large part of them go to ``salts`` partitions instead
    of one, and since both sides are dealt out for this join alone, AQE can
    split such partitions further.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    each = customers.withColumn("_salt", F.explode(
        F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(each, ["customer_id", "_salt"], "inner").drop("_salt")


def member_ids(party: DataFrame, policy: DataFrame, insured: DataFrame,
               id_types: Sequence[str], params: RunParams) -> DataFrame:
    """The ids of ``population`` without computing the latest rows.

    Membership does not depend on the ranking (the class filter comes first
    and every customer keeps exactly one row), so a distinct over the class's
    ids -- a map-side combined hash aggregate -- replaces the window when a
    dataset needs nothing but the ids.
    """
    cls = (party.filter(F.col("idntfctn_type").isin(*id_types))
           .select("customer_id").filter(F.col("customer_id").isNotNull()).distinct())
    return cls.join(active_customer_ids(policy, insured, params), "customer_id", "inner")
