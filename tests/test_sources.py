"""The DataFrame fixture adapters equal the SQL text of the adapters (run by Spark)."""

import pytest

from conftest import SF_SMALL, same_rows
from custmaster.sources import OPTIONAL, Sources
from custmaster.sources.fixtures import ADAPTER_FUNCS
from custmaster.sources.fixture_sql import ADAPTERS


@pytest.fixture(scope="module")
def views(spark):
    for t in ("customer", "orders", "lineitem", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").createOrReplaceTempView(t)
    return True


@pytest.mark.parametrize("role", list(ADAPTER_FUNCS))
def test_adapter_matches_sql(spark, views, role):
    df = getattr(Sources.from_fixtures(spark, SF_SMALL, *OPTIONAL), role)
    sql = spark.sql(ADAPTERS[role].replace("TIMESTAMP", "TIMESTAMP_NTZ"))  # DuckDB's has no zone
    assert df.columns == sql.columns
    assert df.count() == sql.count()
    same_rows(df, sql)


def test_roles_are_lazy(spark):
    src = Sources.from_fixtures(spark, "/nonexistent")
    with pytest.raises(Exception):
        src.party.count()
    with pytest.raises(AttributeError):
        src.not_a_role


def test_from_tables_binds_paths(spark, tmp_path):
    p = str(tmp_path / "cr")
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.parquet(p)
    src = Sources.from_tables(spark, {"country_risk": p})
    assert src.has("country_risk") and not src.has("party")
    assert src.country_risk.count() == 25
