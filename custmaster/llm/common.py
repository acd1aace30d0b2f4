"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custmaster.session import checkpoint_dir

#: ASCII white space as a regular-expression class (space, tab .. carriage return)
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    """The text with null read as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts its lineage there, so
    that a lost executor costs a re-read and not a recomputation, and gives the planner
    the sizes of the written files."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array, empty for none."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (columns compare without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path below the shared folder, and the path there."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def store_bytes(uri: str, data: bytes) -> None:
    """Writes beside the name and moves: a task run again never shows a reader half a file."""
    store, path = filesystem(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    fresh = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(fresh, compression=None) as f:
        f.write(data)
    store.move(fresh, path)


def load_bytes(uri: str) -> bytes:
    store, path = filesystem(uri)
    with store.open_input_file(path) as f:
        return f.read()


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()
