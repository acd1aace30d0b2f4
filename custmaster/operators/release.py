"""Publishing: datasets become visible together, by one rename.

A release folder holds

    versions/<number>/<dataset>/...   what a run wrote, never changed afterwards
    claims/<number>                   a run's number, taken by creating the file
    pointers/<number>                 one small JSON file: the datasets of a version

A run claims the next number, writes its datasets below it and then renames one
finished pointer file into place: that commits all of them.  Readers take the highest
pointer.  Whatever step a run dies at, they read one whole earlier version of every
dataset; the claimed number stays unused.  Pointers are never replaced, so there is no
moment without one, and of two runs at a time the one with the higher number is
current in the end.  ``keep`` versions stay readable.

A pointer names for each dataset its schema (partition columns keep their types), the
folders of its parts, the records and a sketch of the distinct ids that were counted
while it was written, and, for partitioned datasets, a checksum of each partition.
With ``reuse``, partitions whose checksum is that of the version before are not written
again: the new pointer names the old folder.
"""

from __future__ import annotations

import base64
import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: log2 of the sketch's buckets: a standard error of 0.8 %, 4 KB a dataset
SKETCH_LG = 14


@dataclass
class Part:
    """A folder of files; ``value``: the partition's text, None for a dataset without partitions."""
    path: str
    value: str | None = None
    checksum: str | None = None


@dataclass
class Dataset:
    schema: str
    parts: list[Part]
    partition: str | None = None
    records: int | None = None
    ids: str | None = None  # sketch of the distinct ids


@dataclass
class Pointer:
    version: int
    datasets: dict[str, Dataset] = field(default_factory=dict)

    @classmethod
    def load(cls, text: str) -> Pointer:
        raw = json.loads(text)
        return cls(raw["version"], {n: Dataset(**{**d, "parts": [Part(**p) for p in d["parts"]]})
                                    for n, d in raw["datasets"].items()})


class Conflict(RuntimeError):
    """Another run took the number."""


class Release:
    """The release folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        if keep < 1:
            raise ValueError("at least the current version is kept")
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- files -----------------------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _numbers(self, folder: str) -> list[int]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(path) if s.getPath().getName().isdigit())

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # -- reading ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """The committed versions that can be read, ascending."""
        return self._numbers("pointers")

    def pointer(self, version: int | None = None) -> Pointer | None:
        """The pointer of a version (default: the current one); None before the first."""
        there = self.versions()
        if not there:
            return None
        if version is not None and version not in there:
            raise KeyError(f"version {version} is not in {self.root}")
        return Pointer.load(self._read(f"pointers/{version or there[-1]:012d}"))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A dataset of one version, with the schema that it was written with."""
        pointer = self.pointer(version)
        if pointer is None or name not in pointer.datasets:
            raise KeyError(f"{name} is not published in {self.root}")
        data = pointer.datasets[name]
        schema = StructType.fromJson(json.loads(data.schema))
        if data.partition is None:
            return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in data.parts])
        if not data.parts:
            return self.spark.createDataFrame([], schema)
        out, stored = None, StructType([f for f in schema if f.name != data.partition])
        folders: dict[str, list[Part]] = {}
        for p in data.parts:  # one scan a version that parts come from
            folders.setdefault(p.path.rsplit("/", 1)[0], []).append(p)
        for base, parts in folders.items():
            df = (self.spark.read.schema(StructType([*stored, schema[data.partition]])).option("basePath", f"{self.root}/{base}")
                  .parquet(*[f"{self.root}/{p.path}" for p in parts]))
            out = df if out is None else out.unionByName(df)
        return out.select(*schema.names)

    def counts(self, exact: bool = False, key: str = "ID_NO") -> DataFrame:
        """(dataset, records, distinct_ids) of the current version: as counted while it was written,
        ids from the sketches; ``exact`` reads the datasets."""
        names = sorted(self.pointer().datasets)
        if exact:
            out = None
            for name in names:
                one = self.read(name).agg(F.count(F.lit(1)).alias("records"), F.count_distinct(key).alias("distinct_ids"))
                one = one.select(F.lit(name).alias("dataset"), "records", "distinct_ids")
                out = one if out is None else out.unionByName(one)
            return out
        found = self.pointer().datasets
        rows = [(n, found[n].records, base64.b64decode(found[n].ids or "")) for n in names]
        return self.spark.createDataFrame(rows, "dataset string, records long, sketch binary").select(
            "dataset", "records", F.when(F.length("sketch") > 0, F.hll_sketch_estimate("sketch")).otherwise(0).alias("distinct_ids"))

    # -- writing ---------------------------------------------------------------------------

    def begin(self) -> Run:
        """Claims the next number."""
        number = max([0, *self._numbers("pointers"), *self._numbers("claims")]) + 1
        self._fs.mkdirs(self._path("claims"))
        if not self._fs.createNewFile(self._path(f"claims/{number:012d}")):
            raise Conflict(f"version {number} of {self.root} is taken")
        return Run(self, number)

    def _commit(self, pointer: Pointer) -> None:
        self._fs.mkdirs(self._path("pointers"))
        fresh, final = self._path(f"pointers/.{uuid.uuid4().hex}"), self._path(f"pointers/{pointer.version:012d}")
        stream = self._fs.create(fresh, False)
        try:
            stream.write(bytearray(json.dumps(asdict(pointer)).encode()))
        finally:
            stream.close()
        if not self._fs.rename(fresh, final):
            raise Conflict(f"version {pointer.version} of {self.root} is there already")

    def sweep(self) -> None:
        """Removes pointers but the last ``keep``, then folders of versions that no pointer needs and
        that no later run can still be writing."""
        there = self.versions()
        for number in there[:-self.keep]:
            self._fs.delete(self._path(f"pointers/{number:012d}"), False)
        needed = {p.path.split("/")[1] for n in there[-self.keep:] for d in self.pointer(n).datasets.values() for p in d.parts}
        for number in self._numbers("versions"):
            if there and number < there[-1] and f"{number:012d}" not in needed:
                self._fs.delete(self._path(f"versions/{number:012d}"), True)
                self._fs.delete(self._path(f"claims/{number:012d}"), False)


class Run:
    """One version while it is written."""

    def __init__(self, release: Release, number: int):
        self.release, self.number = release, number
        self.pointer = Pointer(number)

    def _checksums(self, df: DataFrame, by: str) -> dict[str | None, str]:
        rows = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                                  F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).collect()
        return {r[by]: f"{r.n}:{r.h}" for r in rows}

    def write(self, name: str, df: DataFrame, partition: str | None = None, key: str = "ID_NO", reuse: bool = False) -> None:
        """Writes a dataset of the version, counting it on the way.  ``partition``: a text column
        (default ``PTN`` where there is one).  ``reuse``: see the module; it computes the dataset
        once more for the checksums and writes only the partitions that changed."""
        partition = partition or ("PTN" if "PTN" in df.columns else None)
        base = f"versions/{self.number:012d}/{name}"
        path = f"{self.release.root}/{base}"
        schema, ids = df.schema.json(), key if key in df.columns else None
        before = self.release.pointer() if reuse else None
        old = before.datasets.get(name) if before else None
        kept: list[Part] = []
        if reuse:
            by = partition or "_whole"
            sums = self._checksums(df.withColumn(by, F.lit("")) if partition is None else df, by)
            if old and old.schema == schema and old.partition == partition:
                kept = [p for p in old.parts if sums.get(p.value if partition else "") == p.checksum]
            if old and len(kept) == len(sums) == len(old.parts) and old.schema == schema and old.partition == partition:
                self.pointer.datasets[name] = Dataset(schema, kept, partition, old.records, old.ids)
                return
            if kept:
                same = [p.value for p in kept]
                changed = ~F.coalesce(F.col(partition).isin([v for v in same if v is not None]), F.lit(False))
                df = df.where(changed & F.col(partition).isNotNull() if None in same else changed)
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("records")]
        if ids:
            measures.append(F.hll_sketch_agg(F.col(ids), F.lit(SKETCH_LG)).alias("ids"))
        df = df.observe(seen, *measures)
        if partition:
            # one shuffle so that each task writes few folders; AQE splits a hot value over several
            # tasks and merges small ones
            df.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
            parts = [Part(f"{base}/{f}", v) for f, v in self._folders(path, partition)]
        else:
            df.write.parquet(path)
            parts = [Part(base)]
        if reuse:
            for p in parts:
                p.checksum = sums.get(p.value if partition else "")
        try:
            got = seen.get
        except Py4JJavaError:  # a plan that is known to be empty has nothing to observe
            got = {"records": 0}
        sketch = bytes(got["ids"]) if got.get("ids") is not None else b""
        records = got["records"]
        if kept:  # the sketch and the count of what was not written again come from its files
            rest = self.release.spark.read.schema(StructType.fromJson(json.loads(schema)))
            row = rest.parquet(*[f"{self.release.root}/{p.path}" for p in kept]).agg(*measures).first()
            records += row.records
            if ids:
                sketch = self._merged([sketch, bytes(row.ids)])
        self.pointer.datasets[name] = Dataset(schema, kept + parts, partition, records, base64.b64encode(sketch).decode())

    def _merged(self, sketches: list[bytes]) -> bytes:
        rows = self.release.spark.createDataFrame([(s,) for s in sketches if s], "s binary")
        return bytes(rows.agg(F.hll_union_agg("s")).first()[0])

    def _folders(self, path: str, partition: str) -> list[tuple[str, str | None]]:
        fs = self.release._fs
        names = [s.getPath().getName() for s in fs.listStatus(self.release._jvm.org.apache.hadoop.fs.Path(path)) if s.isDirectory()]
        unescape = self.release._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = [(n, unescape(n[len(partition) + 1:])) for n in names if n.startswith(f"{partition}=")]
        return sorted((n, None if v == "__HIVE_DEFAULT_PARTITION__" else v) for n, v in found)

    def commit(self) -> Pointer:
        """Makes the version current: all its datasets, by one rename."""
        self.release._commit(self.pointer)
        self.release.sweep()
        return self.pointer


def register_views(release: Release, names: dict[str, str], temporary: bool = True) -> None:
    """Views (dataset -> view name) over the current version.  A catalog's view is replaced in one
    step of the catalog, so SQL users see a whole version of each."""
    for name, view in names.items():
        df = release.read(name)
        if temporary:
            df.createOrReplaceTempView(view)
            continue
        data = release.pointer().datasets[name]
        schema = StructType.fromJson(json.loads(data.schema))
        folders = sorted({p.path.rsplit("/", 1)[0] if data.partition else p.path for p in data.parts})
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        selects = []
        for folder in folders:
            where = ""
            if data.partition and len(folders) > 1:
                own = [p.value for p in data.parts if p.path.rsplit("/", 1)[0] == folder]
                column = f"CAST(`{data.partition}` AS STRING)"
                texts = ", ".join("'" + v.replace("'", "\\'") + "'" for v in own if v is not None) or "NULL"
                where = f" WHERE {column} IN ({texts})" + (f" OR {column} IS NULL" if None in own else "")
            selects.append(f"SELECT {columns} FROM parquet.`{release.root}/{folder}`{where}")
        if selects:
            release.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(selects)}")
