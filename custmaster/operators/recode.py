"""Table-driven conversion of codes, with validity dates.

The configuration has one row a code and period: (code_type, source_code, target_code,
valid_from, valid_to), both ends included and open where null.  On the business date a
source code has one target; if the table has several different ones, the lookup would fan
out, and the plan raises when it is run: no job is started to find out.  Codes
without a valid row pass through.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# code types of the configuration table
MAJOR, MINOR = "1", "2"


def valid_codes(config: DataFrame, code_type: str, as_of: dt.date) -> DataFrame:
    """(source_code, target_code) on a day: each source code once, or an error when it is read."""
    day = F.lit(as_of)
    valid = config.where((F.col("code_type") == code_type) & F.col("source_code").isNotNull()
                         & (F.col("valid_from").isNull() | (F.to_date("valid_from") <= day))
                         & (F.col("valid_to").isNull() | (F.to_date("valid_to") >= day)))
    several = F.concat(F.lit(f"several targets of type {code_type} code "), F.col("source_code"))
    return valid.groupBy("source_code").agg(
        F.min("target_code").alias("_least"), F.max("target_code").alias("_greatest")).select(
        "source_code", F.when(~F.col("_least").eqNullSafe(F.col("_greatest")), F.raise_error(several).cast("string"))
        .otherwise(F.col("_least")).alias("target_code"))


def recoded(df: DataFrame, column: str, config: DataFrame, code_type: str, as_of: dt.date) -> DataFrame:
    """``df`` with the codes of ``column`` converted; codes without a valid target stay."""
    codes = valid_codes(config, code_type, as_of).select(F.col("source_code").alias("_source"), F.col("target_code").alias("_target"))
    j = df.join(codes, df[column].cast("string") == F.col("_source"), "left")
    return j.select(*[F.coalesce("_target", F.col(c).cast("string")).alias(c) if c == column else F.col(c) for c in df.columns])
