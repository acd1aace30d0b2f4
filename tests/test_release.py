"""Publishing: all datasets at once or none, reuse of partitions, counts while writing, views."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from custmaster.operators.release import Release, register_views

NAMES = [f"d{i}" for i in range(8)]


def rows(spark, version, n=20):
    return spark.range(n).select(F.col("id").cast("string").alias("ID_NO"), F.lit(version).alias("v"),
                                 F.when(F.col("id") % 5 == 4, F.lit(None).cast("string"))
                                 .otherwise((F.col("id") % 5).cast("string")).alias("PTN"))


def publish(release, version, names=NAMES, **kw):
    run = release.begin()
    for n in names:
        df = rows(release.spark, version)
        run.write(n, df if n == "d0" else df.drop("PTN"), **kw)
    run.commit()


def seen(spark, root):
    """What a reader that knows nothing else gets: the version in every row of every dataset."""
    release = Release(spark, root)
    return {r.v for n in NAMES for r in release.read(n).select("v").distinct().collect()}


class Dying:
    """A file system on which the process dies at the n-th change."""

    def __init__(self, fs, at):
        self.fs, self.left = fs, at

    def __getattr__(self, name):
        call = getattr(self.fs, name)
        if name not in ("createNewFile", "mkdirs", "create", "rename", "delete"):
            return call

        def counted(*args):
            self.left -= 1
            if self.left < 0:
                raise KeyboardInterrupt(name)
            return call(*args)
        return counted


def test_dying_at_any_step_leaves_one_whole_version(spark, tmp_path):
    root = str(tmp_path / "r")
    names, steps, outcomes = NAMES[:3], 0, []
    publish(Release(spark, root), 1)
    while True:
        release = Release(spark, root)
        release._fs = Dying(release._fs, steps)
        try:
            run = release.begin()
            for n in NAMES:
                run.pointer.datasets[n] = release.pointer().datasets[n]
            for n in names:
                run.write(n, rows(spark, 2).drop("PTN"))
            for n in NAMES[3:]:
                run.write(n, rows(spark, 2).drop("PTN"))
            run.commit()
            done = True
        except KeyboardInterrupt:
            done = False
        got = seen(spark, root)
        assert got in ({1}, {2}), (steps, got)
        outcomes.append(got)
        if done or got == {2}:
            break
        steps += 1
    assert outcomes[0] == {1} and outcomes[-1] == {2} and len(outcomes) > 3


def test_dying_between_writes(spark, tmp_path):
    root = str(tmp_path / "r")
    publish(Release(spark, root), 1)
    for stop in range(len(NAMES)):
        run = Release(spark, root).begin()
        for n in NAMES[:stop]:
            run.write(n, rows(spark, 2).drop("PTN"))
        assert seen(spark, root) == {1}
    bad = rows(spark, 2).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        Release(spark, root).begin().write("d0", bad)
    assert seen(spark, root) == {1}
    publish(Release(spark, root), 3)
    assert seen(spark, root) == {3}


def test_versions_before_stay(spark, tmp_path):
    release = Release(spark, str(tmp_path / "r"), keep=2)
    for v in (1, 2, 3):
        publish(release, v, ["d0"])
    there = release.versions()
    assert len(there) == 2
    assert {r.v for r in release.read("d0", there[0]).collect()} == {2}
    with pytest.raises(KeyError):
        release.pointer(1)
    assert len(os.listdir(tmp_path / "r" / "versions")) == 2


def test_two_runs_at_a_time(spark, tmp_path):
    release = Release(spark, str(tmp_path / "r"))
    first, second = release.begin(), release.begin()
    assert first.number < second.number
    second.write("d0", rows(spark, 2))
    second.commit()
    first.write("d0", rows(spark, 1))
    first.commit()
    assert {r.v for r in release.read("d0").collect()} == {2}


def test_schema_and_null_partition_come_back(spark, tmp_path):
    release = Release(spark, str(tmp_path / "r"))
    publish(release, 1, ["d0"])
    back = release.read("d0")
    assert dict(back.dtypes)["PTN"] == "string" and back.columns == rows(spark, 1).columns
    assert sorted(map(str, back.collect())) == sorted(map(str, rows(spark, 1).collect()))
    run = release.begin()
    run.write("none", rows(spark, 1).limit(0))
    run.write("none_whole", rows(spark, 1).drop("PTN").limit(0))
    run.commit()
    assert release.read("none").count() == release.read("none_whole").count() == 0
    with pytest.raises(KeyError):
        release.read("d0")


def _files(path):
    return {f for f in glob.glob(f"{path}/versions/**/*.parquet", recursive=True)}


def test_reuse_writes_what_changed(spark, tmp_path):
    root = tmp_path / "r"
    release = Release(spark, str(root), keep=2)
    df = rows(spark, 1, 100)
    whole = df.drop("PTN")

    def run(df, whole):
        r = release.begin()
        r.write("by", df, reuse=True)
        r.write("whole", whole, reuse=True)
        r.commit()

    run(df, whole)
    before = _files(root)
    run(df, whole)
    assert _files(root) == before  # nothing was written
    changed = df.withColumn("v", F.when(F.col("ID_NO") == "7", 9).otherwise(F.col("v")))  # PTN 2
    run(changed, whole)
    new = _files(root) - before
    assert new and all("/by/PTN=2/" in f for f in new)
    assert sorted(map(str, release.read("by").collect())) == sorted(map(str, changed.collect()))
    run(changed.where("PTN IS NULL OR PTN <> '3'"), whole)  # a partition goes, none is written
    assert release.read("by").where("PTN = '3'").count() == 0 and release.read("by").count() == 80
    exact, told = ({r.dataset: (r.records, r.distinct_ids) for r in release.counts(exact=e).collect()} for e in (True, False))
    assert {n: c[0] for n, c in told.items()} == {n: c[0] for n, c in exact.items()}
    for v in release.versions():  # what the versions kept share is still there
        assert release.read("by", v).count() in (80, 100)


def test_counts_while_writing(spark, tmp_path):
    release = Release(spark, str(tmp_path / "r"))
    df = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("ID_NO"), F.lit("0").alias("PTN"))
    run = release.begin()
    run.write("many", df)
    run.write("no_ids", spark.range(7).toDF("x"))
    run.commit()
    got = {r.dataset: r for r in release.counts().collect()}
    assert got["many"].records == 60_000 == release.read("many").count()
    assert abs(got["many"].distinct_ids - 20_000) < 0.03 * 20_000
    assert got["no_ids"].records == 7
    run = release.begin()
    run.write("many", df)
    run.commit()
    assert release.counts(exact=True).first().distinct_ids == 20_000


def test_catalog_views_show_the_current_version(spark, tmp_path):
    release = Release(spark, str(tmp_path / "r"))
    for v in (1, 2):
        publish(release, v, ["d0", "d1"])
        register_views(release, {"d0": "rel_d0", "d1": "rel_d1"}, temporary=False)
        assert spark.sql("SELECT DISTINCT v FROM rel_d0 UNION SELECT DISTINCT v FROM rel_d1").first()[0] == v
    assert dict(spark.table("rel_d0").dtypes)["PTN"] == "string"
    assert spark.sql("SELECT count(*) FROM rel_d0 WHERE PTN = '2'").first()[0] == 4
    assert spark.table("rel_d0").count() == 20
    register_views(release, {"d1": "tmp_d1"})
    assert spark.table("tmp_d1").count() == 20
    for view in ("rel_d0", "rel_d1"):
        spark.sql(f"DROP VIEW {view}")


def test_catalog_view_over_parts_of_two_versions(spark, tmp_path):
    release = Release(spark, str(tmp_path / "r"))
    for v in (1, 2):
        run = release.begin()
        run.write("d0", rows(spark, 1).withColumn("v", F.when(F.col("PTN") == "2", v).otherwise(1)), reuse=True)
        run.commit()
    register_views(release, {"d0": "rel_parts"}, temporary=False)
    assert sorted(tuple(r) for r in spark.table("rel_parts").groupBy("v").count().collect()) == [(1, 16), (2, 4)]
    spark.sql("DROP VIEW rel_parts")
