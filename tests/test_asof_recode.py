"""As-of join against a plain version, its spread and plan; code conversion and its guard."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from custmaster.operators.asof import as_of_join
from custmaster.operators.recode import recoded, valid_codes


def d(n):
    return None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def plain(left, right):
    out = []
    for k, n, x in left:
        facts = [(t, v) for j, t, v in right if j == k and k is not None and t is not None and n is not None and t <= n]
        out.append((k, n, x, *max(facts, default=(None, None), key=lambda f: (f[0], f[1] is not None, f[1]))))
    return Counter(out)


@pytest.mark.parametrize("salts", [1, 8])
def test_as_of_join(spark, salts):
    rnd = random.Random(4)
    keys = [None, *range(6)] + [0] * 10  # one key has most of the rows
    left = [(rnd.choice(keys), rnd.choice([None, *range(20)]), rnd.randrange(4)) for _ in range(400)]
    right = [(rnd.choice(keys), rnd.choice([None, *range(0, 20, 3)]), rnd.choice(["a", "b", "c", None])) for _ in range(60)]
    a = spark.createDataFrame([(k, d(n), x) for k, n, x in left], "k int, at timestamp_ntz, x int")
    b = spark.createDataFrame([(k, d(n), v) for k, n, v in right], "k int, since timestamp_ntz, v string")
    got = Counter(tuple(r) for r in as_of_join(a, b, ["k"], "at", "since", ["v"], salts).collect())
    want = Counter({(k, d(n), x, d(t), v): c for (k, n, x, t, v), c in plain(left, right).items()})
    assert got == want


def test_empty_sides(spark):
    a = spark.createDataFrame([(1, d(3))], "k int, at timestamp_ntz")
    b = spark.createDataFrame([(1, d(1), "v")], "k int, since timestamp_ntz, v string")
    assert as_of_join(a.limit(0), b, ["k"], "at", "since", ["v"]).count() == 0
    assert [tuple(r) for r in as_of_join(a, b.limit(0), ["k"], "at", "since", ["v"]).collect()] == [(1, d(3), None, None)]
    with pytest.raises(ValueError):
        as_of_join(a.withColumn("_row", F.lit(1)), b, ["k"], "at", "since", ["v"])


def test_plan_is_one_sort(spark):
    a = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit(d(5)).cast("timestamp_ntz").alias("at"))
    b = spark.range(10).select((F.col("id") % 3).alias("k"), F.lit(d(1)).cast("timestamp_ntz").alias("since"), F.lit("v").alias("v"))
    plan = as_of_join(a, b, ["k"], "at", "since", ["v"])._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("Window ") <= 1


def test_hot_key_is_dealt_out(spark):
    a = spark.range(4000).select(F.lit(1).alias("k"), F.lit(d(5)).cast("timestamp_ntz").alias("at"), "id")
    b = spark.createDataFrame([(1, d(1), "v")], "k int, since timestamp_ntz, v string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in as_of_join(a, b, ["k"], "at", "since", ["v"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(sizes) == 4000 and max(sizes) <= 2000


CONFIG = [("1", "A", "01", None, "2020-01-09"), ("1", "A", "02", "2020-01-10", None), ("1", "B", "03", None, None),
          ("1", "B", "03", "2019-01-01", "2021-01-01"), ("2", "A", "99", None, None), ("1", None, "00", None, None),
          ("1", "C", "04", "2020-02-01", None)]


def config(spark, rows=CONFIG):
    return spark.createDataFrame(rows, "code_type string, source_code string, target_code string, valid_from string, valid_to string") \
        .withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


def test_recode_by_date(spark):
    df = spark.createDataFrame([(c, i) for i, c in enumerate(["A", "B", "C", "Z", "", None, "A"])], "code string, n int")

    def on(day):
        got = recoded(df, "code", config(spark), "1", dt.date.fromisoformat(day))
        assert got.columns == df.columns
        return [r.code for r in sorted(got.collect(), key=lambda r: r.n)]

    assert on("2020-01-09") == ["01", "03", "C", "Z", "", None, "01"]
    assert on("2020-01-10") == ["02", "03", "C", "Z", "", None, "02"]
    assert on("2020-02-01") == ["02", "03", "04", "Z", "", None, "02"]


def test_two_targets_raise_when_run(spark):
    bad = config(spark, CONFIG + [("1", "B", "05", None, None)])
    df = spark.createDataFrame([("A",), ("B",)], "code string")
    out = recoded(df, "code", bad, "1", dt.date(2020, 1, 1))  # planning starts no job and raises nothing
    with pytest.raises(Exception, match="several targets of type 1 code B"):
        out.collect()
    assert valid_codes(bad, "2", dt.date(2020, 1, 1)).count() == 1


def test_lookup_does_not_fan_out(spark):
    df = spark.createDataFrame([("B",)] * 5, "code string")
    assert recoded(df, "code", config(spark), "1", dt.date(2020, 1, 1)).count() == 5
