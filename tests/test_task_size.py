"""Tasks of a bounded size: session settings, partitions by input, distinct before the persons."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from custmaster.functions.columns import text
from custmaster.operators import relations, risk
from custmaster.plans.queries import REGISTRY
from custmaster.session import INITIAL_PARTITIONS, size_shuffles


def hashes(spark, n):
    """32 bytes a row that do not compress."""
    return spark.range(n).select("id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("h"))


def test_a_task_gets_a_bounded_part_of_a_shuffle(spark):
    wide = hashes(spark, 2_000_000)  # 80 MB
    assert wide.groupBy("h").agg(F.max("id")).rdd.getNumPartitions() >= 4


def test_a_scan_task_reads_a_bounded_part_of_a_file(spark, tmp_path):
    path = str(tmp_path / "wide")
    hashes(spark, 4_000_000).coalesce(1).write.option("parquet.block.size", 4 << 20).parquet(path)
    assert spark.read.parquet(path).rdd.getNumPartitions() > 8  # more than one a core


def test_shuffles_start_with_partitions_by_input(spark, tmp_path):
    path = str(tmp_path / "in")
    hashes(spark, 1_000_000).write.parquet(f"{path}/orders.parquet")  # 36 MB or more
    try:
        size_shuffles(spark, f"{path}/{{orders,lineitem}}.parquet")
        assert int(spark.conf.get(INITIAL_PARTITIONS)) >= 16
        size_shuffles(spark, f"{SF_SMALL}/{{orders,lineitem}}.parquet")  # the launcher's number at least
        assert spark.conf.get(INITIAL_PARTITIONS) == spark.conf.get("spark.sql.shuffle.partitions")
        size_shuffles(spark, f"{path}/none.parquet")
        assert spark.conf.get(INITIAL_PARTITIONS) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_what_the_persons_fan_out_is_not_aggregated_again(spark):
    for name, key in (("arm_benef_health", "assured_id"), ("arm_insured", "_rel_id")):
        txt = REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        join = next(line for line in txt.splitlines() if "Join" in line)
        assert key in join and "Aggregate" not in txt[:txt.index(join)], name


def test_arms_with_persons_have_each_row_once(spark):
    """Equal links of several contracts, nulls, unknown persons, persons with several and with null values."""
    links = spark.createDataFrame(
        [(1, 7, "A", "1"), (1, 7, "A", "1"), (2, 7, "A", "1"), (2, 7, "A", None), (1, 8, None, "2"), (3, None, "C", "3"),
         (4, 9, "D", "4"), (None, 9, "D", "4")], "contract_no long, assured_id long, assured_name string, relative_to_insured string")
    bridge = spark.createDataFrame([(1, 100), (2, 100), (2, 101), (3, 100), (4, None)], "contract_no long, customer_id long")
    party = spark.createDataFrame(
        [(7, "1950", 1), (7, "1950", 1), (7, None, None), (7, "1951", 1), (8, None, None), (None, "1960", 3)],
        "customer_id long, birthday string, national_country_code int")
    person = relations.person_lookup(party)
    p = party.select(F.col("customer_id").alias("pid"), "birthday", "national_country_code")
    for how in ("inner", "left"):
        naive = links.join(bridge, "contract_no", how).join(p, F.col("assured_id") == F.col("pid"), "left").select(
            "customer_id", text("assured_name").alias("C_FULLNAME"), text("relative_to_insured").alias("RELATION_CODE"),
            text("birthday").alias("BIRTHDAY_DATE"), text("assured_id").alias("RELATION_ID_NO"),
            text("national_country_code").alias("COUNTRY")).distinct()
        same_rows(naive, relations.health_beneficiary_rows(links, bridge, person, how=how).select(*naive.columns))
        insured = links.select("contract_no", F.col("assured_id").alias("customer_id"), F.col("assured_name").alias("customer_name"),
                               F.col("relative_to_insured").alias("birthday"))
        naive = naive.withColumn("BIRTHDAY_DATE", F.col("RELATION_CODE")).drop("RELATION_CODE").distinct()
        same_rows(naive, relations.insured_rows(insured, bridge, person, how=how).select(*naive.columns))


def test_only_the_given_contracts_ratings_are_copied_to_salts(spark):
    """The ratings meet the contracts before they are copied for the as-of join."""
    rows = [(c, p, r, d) for c in (1, 2, None) for p, r, d in (("X", "10", "2001-01-01"), ("X", "20", "2001-05-01"),
                                                              ("Y", "30", "2002-01-01"), (None, "40", "2001-01-01"), ("Z", "90", None))]
    ratings = spark.createDataFrame(rows, "contract_no long, product_code string, risk_level string, day string").select(
        "contract_no", "product_code", "risk_level", F.col("day").cast("timestamp_ntz").alias("valid_from"))
    contracts = spark.createDataFrame([(1,), (1,), (None,), (5,)], "contract_no long")
    out = risk.contract_product_ratings(ratings, contracts, F.lit("2001-06-01").cast("timestamp_ntz"))
    found = sorted((r.contract_no, r.product_code, r.risk_level) for r in out.collect())
    assert found == [(1, "X", "20"), (1, "Y", None), (1, "Z", None)]
    txt = out._jdf.queryExecution().executedPlan().toString().splitlines()
    copies = next(i for i, line in enumerate(txt) if "Generate explode" in line)
    assert "LeftSemi" in "".join(txt[copies:copies + 12])
