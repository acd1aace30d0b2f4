"""Column rules and code maps on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from custmaster.functions import codes
from custmaster.functions.columns import (birth_digit, flag_or_zero, in_force, non_blank,
                                          stamp, usable_income)


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_map_code_passthrough_and_default(spark):
    df = one_col(spark, ["T010", "T999", None, "T110"])
    got = [r[0] for r in df.select(codes.job_title(F.col("x"))).collect()]
    assert got == ["一般職員", "T999", None, "校長"]
    got = [r[0] for r in one_col(spark, ["1", "2", "3", None, "x"])
           .select(codes.id_type(F.col("x"))).collect()]
    assert got == ["1", "2", "3", "3", "3"]
    got = [r[0] for r in one_col(spark, ["M", "F", None, "U"])
           .select(codes.gender(F.col("x"))).collect()]
    assert got == ["1", "2", "3", "3"]


def test_fixed_maps_are_complete():
    assert len(codes.JOB_TITLES) == 11 and len(codes.PAY_SOURCES) == 7
    assert codes.COUNTRY_RISK == {"10": "1", "20": "2", "25": "2", "30": "3", "90": "4"}
    assert codes.CUSTOMER_RISK == codes.INDUSTRY_RISK == {"00": "1", "30": "3"}


def test_risk_maps(spark):
    df = one_col(spark, ["10", "20", "25", "30", "40", "90", None])
    got = [r[0] for r in df.select(codes.country_risk(F.col("x"))).collect()]
    assert got == ["1", "2", "2", "3", "40", "4", None]


def test_birth_digit(spark):
    df = one_col(spark, ["1987-05-05", "****-**-**", None, "12", "19x0-01-01", ""])
    assert [r[0] for r in df.select(birth_digit(F.col("x"))).collect()] == \
        ["7", "0", "0", "0", "0", "0"]


def test_non_blank_and_usable_income(spark):
    df = spark.createDataFrame([("a", None), ("", 5), ("", None), (None, None), (None, 7)],
                               "s string, i bigint")
    got = [tuple(r) for r in df.select(non_blank("s"),
                                       usable_income(F.col("s"), F.col("i"))).collect()]
    assert got == [(True, True), (False, True), (False, False), (False, False),
                   (False, True)]


def test_in_force_on_the_day(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2001, 6, 1, 23, 0),), (dt.datetime(2001, 5, 31, 23, 59),), (None,)],
        "e timestamp_ntz")
    got = [r[0] for r in df.select(in_force(F.col("e"), dt.date(2001, 6, 1))).collect()]
    assert got == [True, False, True]


def test_flags_and_stamp(spark):
    df = one_col(spark, ["1", None])
    assert [r[0] for r in df.select(flag_or_zero(F.col("x"))).collect()] == ["1", "0"]
    df = one_col(spark, [1, None], "int")
    assert [r[0] for r in df.select(flag_or_zero(F.col("x"))).collect()] == ["1", "0"]
    r = spark.range(1).select(stamp(dt.date(2024, 8, 16)).alias("t")).first()
    assert r["t"] == dt.datetime(2024, 8, 16)
    assert dict(spark.range(1).select(stamp(dt.date(2024, 8, 16)).alias("t")).dtypes)["t"] \
        == "timestamp_ntz"
