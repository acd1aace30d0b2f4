import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from custmaster.session import build_session, checkpoint_dir

    # plans show whole paths of scans, however long the folder of temporary files is named
    s = build_session("local[8]", 8, app_name="custmaster-tests", extra={"spark.sql.maxMetadataStringLength": "1000"})
    # the cluster's spark.checkpoint.dir if configured, else a fresh scratch folder
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def launchers_partitions():
    """Registered queries set the session's first number of shuffle partitions: not for the next test."""
    yield
    from pyspark.sql import SparkSession

    from custmaster.session import INITIAL_PARTITIONS

    s = SparkSession.getActiveSession()
    if s is not None:
        s.conf.unset(INITIAL_PARTITIONS)


@pytest.fixture(scope="session")
def src_small(spark):
    from custmaster.sources import Sources
    return Sources.from_fixtures(spark, SF_SMALL)


@pytest.fixture(scope="session")
def src_oracle(spark):
    from custmaster.sources import Sources
    return Sources.from_fixtures(spark, SF_ORACLE)


def rows(df):
    """Multiset of rows as sorted list of tuples (order-insensitive compare)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_rows(a, b):
    assert a.columns == b.columns or sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


@pytest.fixture(scope="session")
def src_tables(spark, src_small):
    """The sf0.001 adapters written as plain parquet tables (deployment shape:
    one table per role, no adapter joins in the plans)."""
    from custmaster.operators.audit import shared_path
    from custmaster.plans.batch import materialise
    from custmaster.sources import Sources
    tables = {r: materialise(spark, getattr(src_small, r), shared_path(spark, f"fixture_{r}"))
              for r in src_small.roles()}
    return Sources(spark, {r: (lambda d=d: d) for r, d in tables.items()})
