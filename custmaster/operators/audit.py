"""Audit counts and publishing.

* ``audit_counts`` -- records and distinct ids of a dataset (optionally per
  relation type): the numbers the source notes at the top of every file.
* ``publish_roundtrip`` -- publish one dataset (``operators.release``, for the
  commented ``CREATE OR REPLACE TABLE ... AS``) and read it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custmaster.operators.release import Release
from custmaster.session import checkpoint_dir


def audit_counts(df: DataFrame, dataset: str, key: str = "ID_NO",
                 by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by`` group): dataset, [by...], records, distinct_ids."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("records"),
                 F.count_distinct(F.col(key)).alias("distinct_ids")).select(
        F.lit(dataset).alias("dataset"), *by, "records", "distinct_ids")


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, if it is there."""
    fs, p = _files(spark, path)
    fs.delete(p, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the cluster."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def publish_roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Publish the dataset alone in a release of the shared folder and read it back."""
    release = Release(spark, shared_path(spark, name))
    run = release.begin()
    run.write(name, df)
    run.commit()
    return release.read(name)
