"""SQL access: the eight datasets and the source roles as temporary views.

Users who query the datasets with SQL keep their statements: after
``register_views`` the datasets answer to the target-table names of the
source batch (``SELECT * FROM ins_npbasic_tmp``) and to this package's names
(``natural_basic``); the source roles answer to their role names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from custmaster.params import RunParams
from custmaster.plans.datasets import DATASETS
from custmaster.sources import Sources

# Target-table names of the eight datasets in the source batch
TARGET_TABLES = {
    "corporate_basic": "ins_lpbasic_tmp",
    "corporate_contact": "ins_cpcon_tmp",
    "corporate_relations": "ins_lprel_tmp",
    "natural_basic": "ins_npbasic_tmp",
    "natural_contact": "ins_npcon_tmp",
    "natural_relations": "ins_nprel_tmp",
    "corporate_risk": "ins_lprisk_tmp",
    "natural_risk": "ins_nprisk_tmp",
}


def register_views(spark: SparkSession, src: Sources, params: RunParams,
                   with_sources: bool = True) -> list[str]:
    """Create (or replace) temporary views; returns the view names."""
    names = []
    for name, (_, fn) in DATASETS.items():
        df = fn(src, params)
        for view in (name, TARGET_TABLES[name]):
            df.createOrReplaceTempView(view)
            names.append(view)
    if with_sources:
        for role in src.roles():
            getattr(src, role).createOrReplaceTempView(role)
            names.append(role)
    return names
