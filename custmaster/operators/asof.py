"""As-of join: each row of the left side with the right side's latest row of its key
that is not later than the left row's time.

One sort instead of a range join: both sides are put under each other, and in the
order of (key, time) the last right row before a left row is its partner.  A left row and
a right row of the same time meet (the right one sorts first); of right rows of
the same key and time the greatest values win.

A key may hold a large part of the left rows (a product that a third of all
contracts have): its left rows are dealt to ``salts`` windows by a hash of all their
columns, and the right side, which has few rows a key, is copied to each.  Left rows
without key or time, or before the first right row, get nulls; right rows without time
are never valid.  Every left row comes back once, repeated ones as often as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 8


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, since: str,
               values: Sequence[str], salts: int = SALTS) -> DataFrame:
    """``left`` with the columns ``values`` of the right row that is valid at its time ``at``, and that
    row's ``since`` as ``valid_since``."""
    own = left.columns
    taken = {"_salt", "_time", "_row", "_value"} & {c.lower() for c in own}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the way")
    rows = left.select(*keys, F.pmod(F.xxhash64(*own), F.lit(salts)).alias("_salt"), F.col(at).alias("_time"),
                       F.struct(*own).alias("_row"))
    valid = F.struct(F.col(since).alias("valid_since"), *values)
    facts = right.where(F.col(since).isNotNull()).select(
        *keys, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("_salt"),
        F.col(since).alias("_time"), valid.alias("_value"))
    both = rows.withColumn("_value", F.lit(None).cast(facts.schema["_value"].dataType)).unionByName(
        facts.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)))
    order = Window.partitionBy(*keys, "_salt").orderBy(
        F.col("_time").asc_nulls_first(), F.col("_row").isNotNull().asc(), F.col("_value").asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_found", F.last("_value", ignorenulls=True).over(order)).where(F.col("_row").isNotNull())
    known = F.col("_time").isNotNull()
    for k in keys:  # equal keys, as in any join: null matches nothing
        known = known & F.col(k).isNotNull()
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in own],
                        *[F.when(known, F.col(f"_found.{v}")).alias(v) for v in ("valid_since", *values)])
