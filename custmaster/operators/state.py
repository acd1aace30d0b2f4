"""The latest party row of every customer and class as a state that grows by days.

A full run ranks the whole party history.  The state holds what that ranking found up to a
day, one row a (customer, class), so the next day needs the state and that day's new
history rows only: ranking them together gives what ranking the whole history would, since
the latest of a set is the latest of its parts' latest, ties included (``PARTY_ORDER``
decides alike at every step).

    state(n) = latest(state(n - 1) + rows(n))

Rows that arrive late, with an earlier change time, take part like any other.  Membership
in the population is not part of the state: policies change by the day, so a day's
population is the state of that day joined with that day's active ids.

States are versions of a release (``operators.release``), so a day that fails leaves the state
of the day before, and a day can be run again from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custmaster.operators.population import PARTY_ORDER, active_customer_ids, latest_per_key
from custmaster.operators.release import Release
from custmaster.params import RunParams

NAME, CLASS = "latest_party", "_class"


def tagged(party: DataFrame, classes: Mapping[str, Sequence[str]]) -> DataFrame:
    """The history rows of the classes, each with its class's name."""
    tag = F.coalesce(*[F.when(F.col("idntfctn_type").isin(*types), F.lit(name)) for name, types in classes.items()])
    return party.withColumn(CLASS, tag).where(F.col(CLASS).isNotNull() & F.col("customer_id").isNotNull())


class LatestParty:
    """The state below ``root``; ``columns``: the party columns that are kept."""

    def __init__(self, spark: SparkSession, root: str, classes: Mapping[str, Sequence[str]], columns: Sequence[str], keep: int = 2):
        self.release, self.classes, self.columns = Release(spark, root, keep), classes, tuple(columns)

    def add(self, rows: DataFrame) -> int:
        """Adds new history rows (all of them, the first time) and returns the state's version."""
        both = tagged(rows.select(*self.columns), self.classes)
        if self.release.versions():
            both = self.release.read(NAME).unionByName(both)
        run = self.release.begin()
        run.write(NAME, latest_per_key(both, ["customer_id", CLASS], PARTY_ORDER), key="customer_id")
        return run.commit().version

    def latest(self, version: int | None = None) -> DataFrame:
        return self.release.read(NAME, version)

    def population(self, cls: str, policy: DataFrame, insured: DataFrame, params: RunParams) -> DataFrame:
        """The population of a class: the same rows as ``population`` over the whole history."""
        ids = active_customer_ids(policy, insured, params)
        return self.latest().where(F.col(CLASS) == cls).drop(CLASS).join(ids, "customer_id", "inner")
