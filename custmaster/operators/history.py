"""When each id was first published: a history that only grows.

The history of a dataset is a folder of segments, one a run: the ids that the run saw for
the first time, with their date.  A run

* stamps its rows by a left join with the history of the runs before
  (``with_first_created``): an id that is not in it keeps the run's own date, which is
  what the history will say of it.  Nothing is computed beforehand, so a dataset is computed
  once, by its write;
* after the datasets are published, adds a segment of the ids that are new
  (``add_segment``), read from the published files' id column.  Nothing is rewritten; a run
  that fails before publishing leaves no trace.

A segment is moved into place whole, and ids that a crashed run published without
adding its segment are added by the next run that sees them (with that run's date).
Ids are distinct within a segment before they are shuffled (partial aggregate), and the
anti join moves (id, date) pairs only.  ``compact`` rewrites many segments as one.

An id that is absent for some runs stays in the history, so that one who returns keeps the
first date.  A run that is repeated with an earlier date adds a segment that lowers it:
the least date of an id counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class History:
    """First dates of the ids of one dataset, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "ID_NO", date: str = "CREATE_DATE"):
        self.spark, self.path, self.key, self.date = spark, path.rstrip("/"), key, date
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def segments(self) -> list[str]:
        """The segments, oldest first."""
        root = self._at(f"{self.path}/segments")
        if not self._fs.exists(root):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(root)) if not n.startswith("."))

    def first_dates(self) -> DataFrame | None:
        """(key, date): each id once; None before the first run."""
        there = self.segments()
        if not there:
            return None
        ids = self.spark.read.schema(f"{self.key} string, {self.date} timestamp_ntz").parquet(
            *[f"{self.path}/segments/{s}" for s in there])
        # one segment has each id once; a later one has it again only with an earlier date
        return ids if len(there) == 1 else ids.groupBy(self.key).agg(F.min(self.date).alias(self.date))

    def with_first_created(self, rows: DataFrame) -> DataFrame:
        """The rows with the first date of their id, the run's own for new ids."""
        first = self.first_dates()
        if first is None:
            return rows
        j = rows.join(first.withColumnRenamed(self.date, "_first"), self.key, "left")
        return j.select(*[F.least("_first", self.date).alias(c) if c == self.date else F.col(c) for c in rows.columns])

    def new_ids(self, rows: DataFrame) -> DataFrame:
        """(key, date) of the ids that the history does not have, or has with a later date."""
        seen = rows.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(self.date).alias(self.date))
        first = self.first_dates()
        if first is None:
            return seen
        known = first.select(F.col(self.key).alias("_id"), F.col(self.date).alias("_known"))
        return seen.join(known, (F.col(self.key) == F.col("_id")) & (F.col("_known") <= F.col(self.date)), "left_anti")

    def add_segment(self, rows: DataFrame) -> None:
        """Adds the new ids of published rows; a segment without any is not kept."""
        self._put(self.new_ids(rows.select(self.key, self.date)))

    def _put(self, ids: DataFrame) -> str | None:
        there = self.segments()
        number = 1 + max([int(s.split("-")[0]) for s in there], default=0)
        name = f"{number:09d}-{uuid.uuid4().hex[:8]}"
        fresh, final = self._at(f"{self.path}/.{name}"), self._at(f"{self.path}/segments/{name}")
        ids.select(F.col(self.key).cast("string"), self.date).write.parquet(fresh.toString())
        if self.spark.read.schema(f"{self.key} string").parquet(fresh.toString()).isEmpty():
            self._fs.delete(fresh, True)
            return None
        self._fs.mkdirs(final.getParent())
        if not self._fs.rename(fresh, final):
            raise OSError(f"cannot move {fresh} to {final}")
        return name

    def compact(self) -> None:
        """All segments as one; a reader sees the old ones, both, or the new one, with the same dates."""
        before = self.segments()
        if len(before) > 1:
            self._put(self.first_dates())
            for s in before:
                self._fs.delete(self._at(f"{self.path}/segments/{s}"), True)
