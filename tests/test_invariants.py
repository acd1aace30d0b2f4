"""Invariants implied by the counts noted in the source."""

import pytest
from pyspark.sql import functions as F

from custmaster.params import FIXTURE_PARAMS
from custmaster.plans import datasets
from custmaster.plans.queries import REGISTRY
from conftest import SF_ORACLE


@pytest.fixture(scope="module")
def ds(src_oracle):
    return {n: fn(src_oracle, FIXTURE_PARAMS) for n, (_, fn) in datasets.DATASETS.items()}


def _ids(df):
    return df.select("ID_NO").distinct()


@pytest.mark.parametrize("name", ["corporate_basic", "natural_basic", "corporate_risk",
                                  "natural_risk"])
def test_one_row_per_id(ds, name):
    df = ds[name]
    assert df.count() == _ids(df).count() > 0


@pytest.mark.parametrize("cls", ["corporate", "natural"])
def test_basic_and_risk_same_ids(ds, cls):
    a, b = _ids(ds[f"{cls}_basic"]), _ids(ds[f"{cls}_risk"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", ["corporate_contact", "natural_contact",
                                  "corporate_relations", "natural_relations"])
def test_ids_within_basic(ds, name):
    basic = ds[name.split("_")[0] + "_basic"]
    assert _ids(ds[name]).join(_ids(basic), "ID_NO", "left_anti").count() == 0


def test_lookups_do_not_fan_out(src_oracle):
    lk = src_oracle.param_lookup.filter(F.col("param_id") == "RISK_INDUSTRY_TYPE")
    assert lk.count() == lk.select("display_value").distinct().count()
    cr = src_oracle.country_risk
    assert cr.count() == cr.select("country_code").distinct().count()


def test_twin_manager_arms_equal(ds):
    rel = ds["corporate_relations"]
    cols = [c for c in rel.columns if c != "RELATION_TYPE"]
    t2 = rel.filter("RELATION_TYPE = '2'").select(*cols)
    t3 = rel.filter("RELATION_TYPE = '3'").select(*cols)
    assert t2.count() > 0
    assert t2.exceptAll(t3).count() == 0 and t3.exceptAll(t2).count() == 0


@pytest.mark.parametrize("arm", ["arm_agent", "arm_insured", "arm_benef_health",
                                 "arm_benef_travel", "arm_insured_natural"])
def test_no_duplicate_within_arm(spark, arm):
    df = REGISTRY[arm](spark, SF_ORACLE)
    assert df.count() == df.distinct().count()


def test_arm_manager_distinct_per_tag(spark):
    df = REGISTRY["arm_manager"](spark, SF_ORACLE)
    assert df.count() == df.distinct().count()
    assert {r[0] for r in df.select("RELATION_TYPE").distinct().collect()} == {2, 3}
