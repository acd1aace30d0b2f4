"""Input tables of the batch.

``Sources`` is a lazy bundle of the source DataFrames under the role
names used throughout the package (party, policy, insured, ...).  Two ways
to fill it:

* ``Sources.from_fixtures(spark, sf_dir)`` -- the driver's synthetic tables
  through the adapters of ``custmaster.sources.fixtures``;
* ``Sources.from_tables(spark, {"party": "warehouse.party_history", ...})`` -- catalog
  tables or parquet paths of a real deployment (Spark resolves column names
  case-insensitively, so upper-case source columns work unchanged).

Nothing is read until a role is used, and every operator selects only the
columns it needs, so scans stay pruned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from custmaster.sources import fixtures

ROLES = ("party", "policy", "policy_agent", "insured", "benef_health", "benef_travel",
         "income", "entity_manager", "param_lookup", "country_risk", "party_address",
         "income_extra", "product_risk", "industry_codes")
# Optional: a dataset uses them where they are bound.  Their sources have no published
# columns; these are assumed:
#   income_extra   as income; unioned into the declarations
#   product_risk   contract_no, product_code, risk_level, valid_from: the products of a
#                  contract and how each was rated from when on
#   industry_codes code_type ('1' major, '2' minor), source_code, target_code, valid_from,
#                  valid_to (both included, open where null)
OPTIONAL = ("income_extra", "product_risk", "industry_codes")


# The columns of the party history that the datasets use; a real table has more.
PARTY_COLUMNS = (
    "contract_no", "customer_id", "idntfctn_type", "customer_name", "change_date_time", "sex", "birthday",
    "national_country_code", "ocr_country_code", "entity_reg_ctycode", "entity_head_ctycode", "entity_settime",
    "occu_type1_code", "occu_type2_code", "occu_type3_code", "bearer_shares_status", "risk_jobtitle_code",
    "risk_level", "risk_level_update", "san", "mny_err", "sip", "am", "pep", "rca", "risk_industry_code")

# Small tables derived from the party history that several datasets share:
# distinct (contract, customer) pairs, the person lookup, the distinct contact
# rows.  Unbound, every dataset derives them itself; the daily batch
# materialises them once and binds them (``with_derived``).
DERIVED = ("pairs", "persons", "contacts")


class Sources:
    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]],
                 derived: dict[str, DataFrame] | None = None):
        self.spark = spark
        self._loaders = loaders
        self._cache: dict[str, DataFrame] = {}
        self._derived = dict(derived or {})

    def derived(self, name: str) -> DataFrame | None:
        """A bound derived table (see ``DERIVED``), or None."""
        if name not in DERIVED:
            raise KeyError(name)
        return self._derived.get(name)

    def with_derived(self, tables: dict[str, DataFrame]) -> "Sources":
        """A bundle over the same inputs with derived tables bound."""
        out = Sources(self.spark, self._loaders, {**self._derived, **tables})
        out._cache = self._cache
        return out

    def mapped(self, roles: Sequence[str], change: Callable[[DataFrame], DataFrame]) -> "Sources":
        """A bundle whose tables of the given roles go through ``change``; the others are as they are."""
        out = Sources(self.spark, dict(self._loaders), self._derived)
        for role in roles:
            if self.has(role):
                out._loaders[role] = lambda role=role: change(getattr(self, role))
        return out

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_") or role not in ROLES:
            raise AttributeError(role)
        if role not in self._cache:
            if role not in self._loaders:
                raise KeyError(f"no source table bound to role {role!r}")
            self._cache[role] = self._loaders[role]()
        return self._cache[role]

    def has(self, role: str) -> bool:
        return role in self._loaders

    def roles(self) -> list[str]:
        """The roles bound to a table."""
        return list(self._loaders)

    def declarations(self) -> DataFrame:
        """Income declarations of all bound income sources."""
        cols = ["contract_no", "pay_source", "min_year_income", "change_date_time"]
        inc = self.income.select(*cols)
        if self.has("income_extra"):
            inc = inc.unionByName(self.income_extra.select(*cols))
        return inc

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, *optional: str) -> "Sources":
        """The driver's tables; ``optional`` roles (see ``OPTIONAL``) are bound on request."""
        t = fixtures.DriverTables(spark, sf_dir)
        return cls(spark, {r: (lambda f=f: f(t)) for r, f in fixtures.ADAPTER_FUNCS.items()
                           if r in optional or r not in OPTIONAL})

    @classmethod
    def from_tables(cls, spark: SparkSession, names: dict[str, str]) -> "Sources":
        """Bind roles to catalog tables (``db.table``) or parquet paths (``/…``, ``s3://…``)."""
        def loader(name: str) -> Callable[[], DataFrame]:
            if "/" in name:
                return lambda: spark.read.parquet(name)
            return lambda: spark.table(name)
        return cls(spark, {role: loader(n) for role, n in names.items()})
