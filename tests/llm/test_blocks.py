"""Units compared whole or block by block: every pair once, members stored once."""
import glob
import os

import numpy as np
import pyarrow as pa
import pytest

from custmaster.llm import blocks


def _comparison():
    def compare(left, right):
        """Per member how many others it was compared with."""
        if right is None:
            n = left.num_rows
            return pa.table({"node": left.column("node"), "seen": pa.array(np.full(n, n - 1))})
        return pa.table({"node": pa.chunked_array([*left.column("node").chunks, *right.column("node").chunks]),
                         "seen": pa.array(np.repeat([right.num_rows, left.num_rows], [left.num_rows, right.num_rows]))})
    return compare


@pytest.mark.parametrize("block", [1000, 50, 7])
def test_every_pair_once(spark, block):
    rows = [(i, u, n, b"x" * 100) for u, n in ((1, 200), (2, 3), (-5, 49), (7, 60)) for i in range(u * 1000, u * 1000 + n)]
    df = spark.createDataFrame(rows, "node long, unit long, members long, payload binary")
    got = {r.node: r.s for r in blocks.compare_units(df, block, _comparison(), "node long, seen long").groupBy("node")
           .agg({"seen": "sum"}).toDF("node", "s").collect()}
    assert got == {i: n - 1 for i, _, n, _ in rows}


def test_stored_bytes_grow_with_the_members(spark, monkeypatch):
    size, roots = {}, []
    real = blocks.shared_path
    monkeypatch.setattr(blocks, "shared_path", lambda s, w: roots.append(real(s, w)) or roots[-1])
    for n in (400, 1600):
        df = spark.createDataFrame([(i, 1, n, os.urandom(2000)) for i in range(n)],
                                   "node long, unit long, members long, payload binary")
        blocks.compare_units(df, 40, _comparison(), "node long, seen long").count()
        files = glob.glob(roots[-1].removeprefix("file:") + "/*-*")
        size[n] = sum(os.path.getsize(f) for f in files)
    assert 3.5 < size[1600] / size[400] < 4.5


def test_empty(spark):
    df = spark.createDataFrame([], "node long, unit long, members long")
    assert blocks.compare_units(df, 5, _comparison(), "node long, seen long").count() == 0
