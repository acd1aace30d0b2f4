"""Source tables laid out for the batch's joins.

Nearly every join of the batch is on ``contract_no`` (policies, link tables, income, pairs) or
``customer_id`` (party history, persons).  ``bucket_tables`` writes the roles as catalog
tables bucketed and sorted by these keys, with one number of buckets, so that Spark joins
them bucket by bucket: no exchange, and for the sorted side no sort.  It is done once a load,
by whoever loads the tables; the datasets read the tables through ``Sources.from_tables``
without any change.

Tables of a few rows (lookups) are written plainly: they are broadcast anyway.  A key that
holds a large part of a table fills one bucket; such link tables keep the plain layout
(``plain``), where AQE can split the key.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import SparkSession

from custmaster.sources import Sources

BUCKET_KEYS = {
    "policy": "contract_no", "policy_agent": "contract_no", "insured": "contract_no", "benef_health": "contract_no",
    "benef_travel": "contract_no", "income": "contract_no", "income_extra": "contract_no", "product_risk": "contract_no",
    "party": "contract_no", "entity_manager": "customer_id", "party_address": "customer_id"}


def bucket_tables(spark: SparkSession, src: Sources, database: str, buckets: int,
                  plain: Collection[str] = ()) -> Sources:
    """Writes every bound role as ``database.role`` and returns the bundle that reads these tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = {}
    for role in src.roles():
        w = getattr(src, role).write.mode("overwrite").format("parquet")
        key = BUCKET_KEYS.get(role)
        if key and role not in plain:
            w = w.bucketBy(buckets, key).sortBy(key)
        names[role] = f"{database}.{role}"
        w.saveAsTable(names[role])
    return Sources.from_tables(spark, names)
