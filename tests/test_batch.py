"""Daily batch, publishing, audit counts, snapshot merge, checkpoint folder."""

import datetime as dt
import os

from pyspark.sql import functions as F

from custmaster.params import FIXTURE_PARAMS, RunParams
from custmaster.operators.audit import audit_counts, publish_roundtrip, shared_path
from custmaster.operators.release import Release
from custmaster.plans import batch, datasets
from custmaster.session import checkpoint_dir


def test_checkpoint_dir_comes_from_session(spark):
    d = checkpoint_dir(spark)
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert d
    if conf:                       # configured by the cluster: used, not replaced
        assert d.startswith(("file:" + conf, conf))


def test_run_daily_publishes_all_datasets(spark, src_small, tmp_path):
    out = str(tmp_path / "out")
    counts = {r["dataset"]: (r["records"], r["distinct_ids"])
              for r in batch.run_daily(spark, src_small, out, FIXTURE_PARAMS).collect()}
    assert set(counts) == set(datasets.DATASETS)
    release = Release(spark, out)
    exact = {r.dataset: (r.records, r.distinct_ids) for r in release.counts(exact=True).collect()}
    for name, (_, fn) in datasets.DATASETS.items():
        df = fn(src_small, FIXTURE_PARAMS)
        back = release.read(name)
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0, name
        assert counts[name][0] == exact[name][0]
        assert abs(counts[name][1] - exact[name][1]) <= 0.03 * exact[name][1], name
    assert len(release.pointer().datasets["natural_contact"].parts) > 1


def test_publish_roundtrip_keeps_text_partition(spark, src_small):
    df = datasets.natural_contact(src_small, FIXTURE_PARAMS)
    back = publish_roundtrip(spark, df, "nc")
    assert dict(back.dtypes)["PTN"] == "string"
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_audit_counts_by_type(src_small):
    rel = datasets.corporate_relations(src_small, FIXTURE_PARAMS)
    c = audit_counts(rel, "corporate_relations", by=["RELATION_TYPE"])
    total = sum(r["records"] for r in c.collect())
    assert total == rel.count()


def test_run_daily_keeps_history_and_cleans_up(spark, src_small, tmp_path):
    out, h = str(tmp_path / "out"), str(tmp_path / "h")
    first = RunParams(as_of=FIXTURE_PARAMS.as_of, create_date=dt.date(2024, 1, 1))
    second = RunParams(as_of=FIXTURE_PARAMS.as_of, create_date=dt.date(2024, 2, 1))
    batch.run_daily(spark, src_small, out, first, history=h)
    batch.run_daily(spark, src_small, out, second, history=h, with_address=True, with_insured=True)
    release = Release(spark, out)
    for name in datasets.DATASETS:
        stamps = [r[0] for r in release.read(name).select("CREATE_DATE").distinct().collect()]
        assert stamps == [dt.datetime(2024, 1, 1)], name
        assert len(os.listdir(f"{h}/{name}/segments")) == 1, name
    assert "REGISTERED_ADDR" in release.read("natural_basic").columns
    kinds = {r[0] for r in release.read("natural_relations").select("RELATION_TYPE").distinct().collect()}
    assert "4" in kinds
    base = checkpoint_dir(spark).replace("file:", "")
    assert not [x for x in os.listdir(f"{base}/tables") if x.startswith("run_")]


def test_second_run_without_changes_writes_no_file(spark, src_small, tmp_path):
    out = tmp_path / "out"
    batch.run_daily(spark, src_small, str(out), FIXTURE_PARAMS, reuse=True)
    files = sorted(str(f) for f in out.glob("versions/**/*.parquet"))
    batch.run_daily(spark, src_small, str(out), FIXTURE_PARAMS, reuse=True)
    assert files and sorted(str(f) for f in out.glob("versions/**/*.parquet")) == files
    assert len(Release(spark, str(out)).versions()) == 2


def test_failed_run_leaves_the_version_before(spark, src_small, tmp_path, monkeypatch):
    import pytest
    out = str(tmp_path / "out")
    batch.run_daily(spark, src_small, out, FIXTURE_PARAMS)
    before = Release(spark, out).pointer()
    cls, good = datasets.DATASETS["natural_risk"]
    monkeypatch.setitem(datasets.DATASETS, "natural_risk", (cls, lambda *a, **k: good(*a, **k).withColumn(
        "SOURCE", F.raise_error(F.lit("no")).cast("string"))))
    with pytest.raises(Exception):
        batch.run_daily(spark, src_small, out, RunParams(as_of=dt.date(2001, 3, 1)))
    assert Release(spark, out).pointer() == before


def test_populations_checkpointed(spark, src_small):
    pops = batch.populations(spark, src_small, FIXTURE_PARAMS, shared_path(spark, "pops"))
    for cls, pop in pops.items():
        txt = pop._jdf.queryExecution().analyzed().toString()
        assert "Relation" in txt and "parquet" in txt.lower(), cls   # lineage cut: a written table
        plan = pop._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_class" in plan, cls    # reads its class only
        same = datasets.class_population(src_small, cls, FIXTURE_PARAMS)
        assert pop.exceptAll(same.select(*pop.columns)).count() == 0
        assert same.select(*pop.columns).exceptAll(pop).count() == 0
    assert pops["natural"].filter(F.col("customer_id").isNull()).count() == 0


def test_views_answer_to_target_names(spark, src_small):
    from custmaster.plans.views import register_views
    names = register_views(spark, src_small, FIXTURE_PARAMS)
    assert "ins_nprisk_tmp" in names and "party" in names
    a = spark.sql("SELECT COUNT(*) AS n, COUNT(DISTINCT ID_NO) AS d FROM ins_nprisk_tmp").first()
    assert a["n"] == a["d"] == datasets.natural_risk(src_small, FIXTURE_PARAMS).count()


def test_cli_runs_the_batch(tmp_path, capsys):
    from custmaster.__main__ import main
    main(["--fixtures", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")])
    out = capsys.readouterr().out
    assert out.count("records=") == 8


def test_cli_needs_a_business_date_for_tables(tmp_path):
    import pytest
    from custmaster.__main__ import main
    with pytest.raises(SystemExit):
        main(["--tables", str(tmp_path / "t.json"), "--out", str(tmp_path / "o")])
