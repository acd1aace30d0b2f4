"""Spark session settings for the customer-master batch.

The jobs are plain DataFrame plans; these settings only decide how Spark
executes them:

* ANSI SQL semantics and a UTC session clock, so that casts and the
  business date behave the same on every cluster.
* Adaptive query execution with skew-join splitting: contract and customer
  keys are skewed (one group policy can carry a third of all insured rows),
  and AQE splits such partitions at run time instead of one task doing them.
* Broadcast joins only below a size in bytes that Spark checks itself.
* No Spark UI (no server is opened).

* Tasks of a bounded size: a scan task reads 16 MB of files and AQE merges shuffle
  partitions up to 16 MB.  Both are compressed bytes; the wide party rows take 5 to
  20 times as much in a sort or a hash table, so a task's memory stays at a few hundred
  MB whatever the input's size.

``spark.sql.shuffle.partitions`` is the launcher's choice: a few times the
cluster's cores, and enough that the largest shuffle's bytes divided by it fit
a task's memory.  AQE merges partitions that turn out small; it does not make
more of them, so ``size_shuffles`` starts with more of them on a larger input.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this package wants, local or cluster.
BASE_CONF: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory size rather than keeping many tiny tasks (the
    # setting Spark recommends for busy clusters; it costs parallelism on inputs
    # as small as the bench's)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition is skewed when it is 4x the median and above 32 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    # it applies to joins whose two sides are dealt out for the join alone; where
    # one side arrives already hashed by the key (distinct ids), the join is
    # salted instead (operators.population.for_customers)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Spark broadcasts a side whose estimated size (of its files, compressed: some 15
    # times as much as a hash table) or measured size (AQE, of its rows) is below
    # this; code tables are, everything else is shuffled
    "spark.sql.autoBroadcastJoinThreshold": "2m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    # the income profile keeps a few codes a customer: let its hash aggregate
    # hold this many customers before it falls back to sorting (default 128)
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# The largest shuffles of the batch write about eight times the bytes of the tables.
INPUT_BYTES_A_PARTITION = 2 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, paths: str) -> None:
    """Lets shuffles start with partitions in proportion to the bytes of the files that ``paths`` (a
    Hadoop glob) names, with the launcher's number at least; AQE merges those that turn out small."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = sum(fs.getContentSummary(f.getPath()).getLength() for f in fs.globStatus(path) or [])
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(max(least, size // INPUT_BYTES_A_PARTITION)))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "custmaster", extra: dict[str, str] | None = None
                  ) -> SparkSession:
    """Create (or get) a session with ``BASE_CONF``.

    ``master`` is only given for local runs (tests, bench); on a cluster the
    launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        # getOrCreate may return an existing session: apply the SQL settings
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and published intermediate tables.

    Read from the running context (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``).  Only when neither is set -- local tests and the
    bench -- a fresh scratch folder is made and registered; on a cluster the
    setting must come from the cluster, never from a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    path = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
