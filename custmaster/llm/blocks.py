"""Comparing all members of a unit (bucket, cell, group) with each other.

``compare_units`` calls a comparison for every unit's members, without pairs as rows:

* A unit of up to ``block`` members is one call, inside the task that its rows
  were dealt to.
* A larger one is dealt into blocks by the same shuffle.  Each block is written once, as
  one file of the shared folder, and every pair of blocks is a row of three numbers whose
  task reads the two files.  What is shuffled grows with the members (and a row
  a pair of blocks), not with members times blocks; no member is capped or
  skipped, and no task holds more than two blocks.

The files are moved into place whole and a block's content does not depend on
when its task ran, so a task that is run again rewrites the same file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from custmaster.llm.common import load_bytes, materialise, shared_path, store_bytes

#: comparison(left, right): members of a unit, or two blocks of them; right is None where all
#: pairs inside left are meant
Comparison = Callable[[pa.Table, pa.Table | None], pa.Table | None]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (unit, block), of batches sorted by these two columns."""
    open_rows: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        unit, block = batch.column("unit").to_numpy(), batch.column("block").to_numpy()
        cuts = np.flatnonzero((unit[1:] != unit[:-1]) | (block[1:] != block[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(unit)]):
            key = (unit[begin], block[begin])
            if open_rows and key != last:
                yield pa.Table.from_batches(open_rows)
                open_rows = []
            last = key
            open_rows.append(batch.slice(begin, end - begin))
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def _gathered(tables: Iterator[pa.Table | None], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Record batches of many small results."""
    held, n = [], 0
    for t in tables:
        if t is not None and t.num_rows:
            held.append(t)
            n += t.num_rows
        if n >= rows:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


MARK = "_unit bigint, _block int, _blocks int"


def _write_block(root: str, rows: pa.Table) -> None:
    unit, block = rows.column("unit")[0].as_py(), rows.column("block")[0].as_py()
    sink = pa.BufferOutputStream()
    members = rows.drop_columns(["block", "blocks"]).combine_chunks()
    with pa.ipc.new_stream(sink, members.schema) as out:
        out.write_table(members)
    store_bytes(f"{root}/{unit}-{block}", sink.getvalue().to_pybytes())


def _inside(root: str, compare: Comparison, columns: pa.Schema):
    """The results of whole units; of others, whose blocks it writes, a mark a block."""
    def results(batches):
        for rows in runs(batches):
            if rows.column("blocks")[0].as_py() == 1:
                found = compare(rows.drop_columns(["block", "blocks"]), None)
                if found is not None:
                    n = found.num_rows
                    yield pa.table([*found.select(columns.names).columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                                    pa.nulls(n, pa.int32())], names=[*columns.names, "_unit", "_block", "_blocks"])
            else:
                _write_block(root, rows)
                one = rows.slice(0, 1)
                yield pa.table([*(pa.nulls(1, f.type) for f in columns),
                                *(one.column(c) for c in ("unit", "block", "blocks"))],
                               names=[*columns.names, "_unit", "_block", "_blocks"])

    return lambda batches: _gathered(results(batches))


def _between(root: str, compare: Comparison):
    def read(unit: int, block: int) -> pa.Table:
        return pa.ipc.open_stream(load_bytes(f"{root}/{unit}-{block}")).read_all()

    def results(batches):
        held = (None, None)
        for batch in batches:
            for unit, i, j in zip(*(c.to_pylist() for c in batch.columns)):
                if held[0] != (unit, i):
                    held = ((unit, i), read(unit, i))
                yield compare(held[1], None if i == j else read(unit, j))

    return lambda batches: _gathered(results(batches))


def compare_units(members: DataFrame, block: int, compare: Comparison, schema: str) -> DataFrame:
    """The rows of ``compare`` for all units of ``members``: columns unit (long), members (the
    unit's rows, or 0 where they are known to be few) and whatever the comparison reads.  Written,
    so its own input is read once."""
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    payload = [c for c in members.columns if c not in ("unit", "members")]
    root = shared_path(spark, "blocks")
    columns = to_arrow_schema(StructType.fromDDL(schema))
    # blocks half full: hashes deal unevenly
    blocks = F.when(F.col("members") > block, F.ceil(F.col("members") * 2 / block)).otherwise(1).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64(payload[0]), F.col("blocks")).cast("int"))
    dealt = dealt.select("unit", "block", "blocks", *payload).repartition(parts, "unit", "block")
    out = materialise(dealt.sortWithinPartitions("unit", "block").mapInArrow(
        _inside(root, compare, columns), f"{schema}, {MARK}"), "within")

    marks = out.where("_unit IS NOT NULL").select(F.col("_unit").alias("unit"), F.col("_block").alias("i"), "_blocks")
    pairs = marks.select("unit", "i", F.explode(F.sequence("i", F.col("_blocks") - 1)).alias("j"))
    pairs = pairs.join(marks.select("unit", F.col("i").alias("j")), ["unit", "j"], "left_semi")
    between = (pairs.select("unit", "i", "j").repartition(parts, "unit", "i", "j").sortWithinPartitions("unit", "i", "j")
               .mapInArrow(_between(root, compare), schema))
    found = out.where("_unit IS NULL").drop("_unit", "_block", "_blocks")
    return found.unionByName(materialise(between, "between"))
