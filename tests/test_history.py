"""First-creation dates: absences, late runs, growth by segments, datasets computed once."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from custmaster.operators.history import History
from custmaster.operators.release import Release


def day(spark, rows):
    return spark.createDataFrame([(i, v, dt.datetime.fromisoformat(d)) for i, v, d in rows],
                                 "ID_NO string, V string, CREATE_DATE timestamp_ntz")


def dates(history):
    return {r.ID_NO: r.CREATE_DATE.date().isoformat() for r in history.first_dates().collect()}


def run(spark, release, history, df):
    r = release.begin()
    r.write("d", history.with_first_created(df))
    r.commit()
    history.add_segment(release.read("d"))
    return {r.ID_NO: r.CREATE_DATE.date().isoformat() for r in release.read("d").collect()}


@pytest.fixture
def places(spark, tmp_path):
    return Release(spark, str(tmp_path / "r")), History(spark, str(tmp_path / "h"))


def test_first_creation_survives_absence(spark, places):
    release, history = places
    assert run(spark, release, history, day(spark, [("1", "a", "2024-01-01"), ("2", "b", "2024-01-01")])) == {
        "1": "2024-01-01", "2": "2024-01-01"}
    run(spark, release, history, day(spark, [("2", "b2", "2024-02-01"), ("3", "c", "2024-02-01"), (None, "x", "2024-02-01")]))
    assert run(spark, release, history, day(spark, [("1", "a3", "2024-03-01"), ("3", "c3", "2024-03-01"),
                                                   ("3", "c4", "2024-03-01")])) == {"1": "2024-01-01", "3": "2024-02-01"}
    assert dates(history) == {"1": "2024-01-01", "2": "2024-01-01", "3": "2024-02-01"}


def test_only_new_ids_are_written(spark, places):
    release, history = places
    many = [(str(i), "v", "2024-01-01") for i in range(100)]
    run(spark, release, history, day(spark, many))
    run(spark, release, history, day(spark, [(i, v, "2024-02-01") for i, v, _ in many] + [("new", "v", "2024-02-01")]))
    assert len(history.segments()) == 2
    assert spark.read.parquet(f"{history.path}/segments/{history.segments()[1]}").count() == 1
    run(spark, release, history, day(spark, [(i, v, "2024-03-01") for i, v, _ in many]))
    assert len(history.segments()) == 2  # nothing new, no segment
    before = dates(history)
    history.compact()
    assert len(history.segments()) == 1 and dates(history) == before


def test_an_earlier_date_counts(spark, places):
    release, history = places
    run(spark, release, history, day(spark, [("1", "a", "2024-02-01")]))
    assert run(spark, release, history, day(spark, [("1", "a", "2024-01-01")])) == {"1": "2024-01-01"}
    assert dates(history) == {"1": "2024-01-01"}


def test_a_failed_run_leaves_no_trace(spark, places):
    release, history = places
    run(spark, release, history, day(spark, [("1", "a", "2024-01-01")]))
    bad = day(spark, [("1", "a", "2024-02-01"), ("9", "x", "2024-02-01")]).withColumn(
        "V", F.when(F.col("ID_NO") == "9", F.raise_error(F.lit("no"))).otherwise(F.col("V")))
    with pytest.raises(Exception):
        run(spark, release, history, bad)
    assert dates(history) == {"1": "2024-01-01"}
    assert run(spark, release, history, day(spark, [("9", "x", "2024-03-01")])) == {"9": "2024-03-01"}


def test_a_dataset_is_computed_once(spark, places, tmp_path):
    """The rows to publish read their inputs once; the new ids come from the published files."""
    release, history = places
    path = str(tmp_path / "input")
    day(spark, [(str(i), "v", "2024-02-01") for i in range(1000)]).write.parquet(path)
    run(spark, release, history, day(spark, [(str(i), "v", "2024-01-01") for i in range(990)]))
    rows = history.with_first_created(spark.read.parquet(path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{os.path.basename(path)}]") == 1
    assert run(spark, release, history, spark.read.parquet(path))["995"] == "2024-02-01"
    fresh = history.new_ids(release.read("d"))._jdf.queryExecution().executedPlan().toString()
    assert os.path.basename(path) + "]" not in fresh
