"""Embedding near-duplicates by lattice hashing: random projections, E8 cells, exact cosine.

1. Rows with equal label and vector are copies: one node stands for them, so a
   group of copies of any size costs one row.
2. A table projects a node's unit vector to eight random directions and decodes
   the point to the nearest point of the lattice E8: its own cell.  It also
   visits the cells of the next ``PROBES`` lattice neighbours.  A pair meets in a
   table if either one's own cell is among the cells of the other.
3. In a cell, owners are compared with owners and visitors by cosine in double
   precision.  Pairs are not emitted: a cell gives each member the number of its
   links and the least member it is connected with.  A pair that meets in
   several cells is counted in the first one only (by table, then by cell); both
   rows' cells follow from their vectors, so no list of pairs is needed for that.
4. Connected components of the cells' edges are the classes.

``plan`` fixes scale and tables from the rows of the largest label: the scale
grows until a cell of spread-out vectors holds at most ``CELL`` of them, and
there are as many tables as it takes to find a pair exactly at the threshold
with probability ``RECALL``; nearer pairs are found more surely.  The rule is the same
at every size.  Cells of more than ``BLOCK`` members, such as those of large
groups of near copies, are compared block by block (``blocks``): none is
capped.

Null labels, null, empty or zero vectors and those with null or non-finite components
link with nothing: no links, a class of their own.  Vectors of different lengths are not
compared.  Repeated rows, and rows of one id, are vectors of their own.  A row
without id counts as a vector, and gets the least id that it is connected with,
or none; it is kept if it has none.  Pairs exactly at the threshold link.  An
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, log, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.llm.blocks import compare_units
from custmaster.llm.common import materialise
from custmaster.llm.components import SALTS, components, roots

THRESHOLD = 0.93
RECALL = 0.998
PROBES = 2
CELL = 4096
LEAST_SCALE = 1.5
BLOCK = 4096
_ROWS = 256  # rows of a comparison whose linked pairs are held at once
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- the lattice --------------------------------------------------------------------------

@lru_cache(1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [np.eye(8)[i] * a + np.eye(8)[j] * b
             for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(pairs + halves)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    out = np.rint(x)
    odd = np.flatnonzero(out.sum(1) % 2)
    error = x[odd] - out[odd]
    worst = np.abs(error).argmax(1)
    out[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1, -1)
    return out


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: whole coordinates of even sum, or these moved by a half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


@dataclass(frozen=True)
class Plan:
    scale: float
    tables: int
    probes: int = PROBES
    threshold: float = THRESHOLD

    @lru_cache(64)
    def directions(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """(tables, dim, 8) scaled orthonormal directions and (tables, 8) offsets."""
        rng = np.random.default_rng(dim)
        size = max(dim, 8)
        q = [np.linalg.qr(rng.standard_normal((size, size)))[0][:dim, :8] for _ in range(self.tables)]
        return np.array(q) * self.scale * (size / 8) ** 0.5, rng.random((self.tables, 8))

    def cells(self, unit: np.ndarray, label: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) hashes of table, label, length and lattice point; the own cell first."""
        directions, offsets = self.directions(unit.shape[1])
        out = np.empty((len(unit), self.tables, 1 + self.probes), np.uint64)
        roots_ = neighbours()
        for t in range(self.tables):
            x = unit @ directions[t] + offsets[t]
            own = decode(x)
            near = np.argsort(-((x - own) @ roots_.T), axis=1, kind="stable")[:, :self.probes]
            points = np.concatenate([own[:, None], own[:, None] + roots_[near]], axis=1)
            whole = np.rint(2 * points).astype(np.int64).view(np.uint64)
            h = (label.astype(np.int64).view(np.uint64) * _MIX + np.uint64(t * 65_537 + unit.shape[1]))[:, None]
            for c in range(8):
                h = (h ^ (h >> np.uint64(31))) * _MIX + whole[:, :, c]
            out[:, t] = (h ^ (h >> np.uint64(29))) * _MIX
        return out


def hit_rate(scale: float, probes: int = PROBES, threshold: float = THRESHOLD, pairs: int = 4000) -> float:
    """How often a pair exactly at the threshold meets in one table."""
    rng = np.random.default_rng(7)
    a, b = rng.standard_normal((2, pairs, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b = threshold * a + (1 - threshold ** 2) ** 0.5 * b / np.linalg.norm(b, axis=1)[:, None]
    plan, none = Plan(scale, 4, probes, threshold), np.zeros(pairs, np.int64)
    return float(_meet(plan.cells(a, none), plan.cells(b, none)).mean())


def plan(rows: int, probes: int = PROBES, threshold: float = THRESHOLD, recall: float = RECALL) -> Plan:
    """Scale and tables for ``rows`` vectors of a label."""
    scale = LEAST_SCALE
    while rows * (pi / 2 * scale ** 2) ** -4 > CELL:  # the share of spread-out vectors in one cell
        scale *= 1.05
    return Plan(scale, ceil(log(1 - recall) / log(1 - hit_rate(scale, probes, threshold))), probes, threshold)


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(pairs, tables): whether one's own cell is among the other's."""
    return (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)


# -- cells --------------------------------------------------------------------------------

def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one (scaled first, so that no square overflows)."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))


def _cell_rows(how: Plan):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                embedding = part.column("embedding")
                length = pc.list_value_length(embedding).to_numpy(zero_copy_only=False)
                for dim in np.unique(length):
                    own = np.flatnonzero(length == dim)
                    raw = np.ascontiguousarray(embedding.take(pa.array(own)).flatten().to_numpy().reshape(len(own), dim))
                    label = part.column("label").to_numpy()[own]
                    cells = how.cells(units(raw.astype(float)), label)
                    width = 1 + how.probes
                    again = np.repeat(np.arange(len(own)), how.tables * width)
                    column = {
                        "unit": pa.array(cells.ravel().view(np.int64)),
                        "node": pa.array(part.column("node").to_numpy()[own][again]),
                        "at": pa.array(np.tile(np.repeat(np.arange(how.tables, dtype=np.int32), width), len(own))),
                        "own": pa.array(np.tile(np.arange(width) == 0, len(own) * how.tables)),
                        "label": pa.array(label[again]),
                        "copies": pa.array(part.column("copies").to_numpy()[own][again]),
                        "vector": pa.array([x.tobytes() for x in raw], pa.binary()).take(pa.array(again))}
                    yield pa.RecordBatch.from_pydict(column)

    return rows


def _rows_of(vectors: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), kind).reshape(len(vectors), -1).astype(float)


def _alike(rows: pa.Table) -> Iterator[pa.Table]:
    """The rows of one table, label and length each (hashes of different cells may be equal)."""
    length = pc.binary_length(rows.column("vector").combine_chunks())
    key = np.stack([rows.column("at").to_numpy(), rows.column("label").to_numpy(), length.to_numpy()], 1)
    if (key == key[0]).all():
        yield rows
        return
    for k in np.unique(key, axis=0):
        yield rows.take(pa.array(np.flatnonzero((key == k).all(1))))


def _compared(how: Plan, kind: str):
    """(node, links, root) of the members that have links to count in this cell."""
    def pairs_of(rows: pa.Table, n_left: int | None) -> pa.Table | None:
        n = rows.num_rows
        own = rows.column("own").to_numpy()
        if n < 2 or not own.any():
            return None
        x = units(_rows_of(rows.column("vector"), kind))
        label = rows.column("label").to_numpy()
        table, unit = rows.column("at")[0].as_py(), np.uint64(rows.column("unit")[0].as_py() & (1 << 64) - 1)
        copies = rows.column("copies").to_numpy()
        cells, links, root = None, np.zeros(n, np.int64), np.arange(n)
        for begin in range(0, n if n_left is None else n_left, _ROWS):
            end = min(begin + _ROWS, n if n_left is None else n_left)
            first = begin if n_left is None else n_left
            alike = x[begin:end] @ x[first:].T >= how.threshold
            alike &= own[begin:end, None] | own[None, first:]
            a, b = np.nonzero(alike)
            a, b = a + begin, b + first
            a, b = (c[a < b] for c in (a, b))
            if not len(a):
                continue
            if cells is None:
                cells = how.cells(x, label)
            # counted where the pair meets first: no earlier table, nor a lesser cell of this one
            earlier = _meet(cells[a, :table], cells[b, :table]).any(1)
            left, right = cells[a, table], cells[b, table]
            both = (left[:, :1] == right).any(1) & (right[:, :1] == left).any(1)
            here = ~earlier & (~both | (np.minimum(left[:, 0], right[:, 0]) == unit))
            a, b = a[here], b[here]
            links += np.bincount(a, copies[b], n).astype(np.int64) + np.bincount(b, copies[a], n).astype(np.int64)
            apart = root[a] != root[b]
            if apart.any():
                root = roots(n, root[a[apart]], root[b[apart]])[root]
        has = np.flatnonzero(links)
        node = rows.column("node").to_numpy()
        return pa.table({"node": node[has], "links": links[has], "root": node[root[has]]}) if len(has) else None

    def compare(left: pa.Table, right: pa.Table | None) -> pa.Table | None:
        found = []
        for part in _alike(left if right is None else pa.concat_tables([left, right])):
            n_left = None
            if right is not None:  # rows of the left block come first
                n_left = int(np.isin(part.column("node").to_numpy(), left.column("node").to_numpy()).sum())
            found.append(pairs_of(part, n_left))
        found = [f for f in found if f is not None]
        return pa.concat_tables(found) if found else None

    return compare


# -- the operator -------------------------------------------------------------------------

def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label)."""
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    embedding = F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>")
    usable = (F.col("label").isNotNull() & (F.size("embedding") > 0)
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    keyed = [F.xxhash64(F.lit(i), "label", "embedding") for i in (1, 2)]
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          embedding.alias("embedding"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False))).select(
        "vec_id", "label", "embedding", *[F.when(F.col("usable"), k).alias(f"k{i}") for i, k in enumerate(keyed)])
    nodes = rows.where("k0 IS NOT NULL").groupBy("k0", "k1").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")).withColumn("node", F.monotonically_increasing_id())
    nodes = materialise(nodes, "nodes")

    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    how = plan(most, threshold=threshold, recall=recall)
    cells = nodes.select("node", "label", "copies", "embedding").mapInArrow(
        _cell_rows(how), "unit bigint, node bigint, at int, own boolean, label bigint, copies bigint, vector binary")
    large = materialise(cells.groupBy("unit").agg(F.count("*").alias("members")).where(F.col("members") > BLOCK), "large")
    members = cells.join(large, "unit", "left").withColumn("members", F.coalesce("members", F.lit(0).cast("long")))
    found = compare_units(members.select("node", "unit", "at", "own", "label", "copies", "vector", "members"),
                          BLOCK, _compared(how, kind), "node bigint, links bigint, root bigint")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (nodes.select("k0", "k1", "id", "copies", "node").join(links, "node", "left").join(classes, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    known = materialise(known, "classes")
    least = known.groupBy("component").agg(F.min("id").alias("component_id"))
    # a vector may have very many copies: their rows meet its class in SALTS places
    told = known.join(least, "component").select(
        "k0", "k1", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))
    salted = rows.drop("embedding", "label").withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    out = salted.join(told, ["k0", "k1", "salt"], "left").withColumn(
        "component_id", F.when(F.col("k0").isNull(), F.col("vec_id")).otherwise(F.col("component_id")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def digest(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


#: The digest in SQL: every pair of a label. Only for tables of test size.
ORACLE_SQL = """
WITH RECURSIVE
good AS (SELECT row_number() OVER () AS r, vec_id, label, embedding,
                label IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable FROM embeddings),
pairs AS (SELECT a.r AS x, b.r AS y FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r
            AND len(a.embedding) = len(b.embedding)
          WHERE a.usable AND b.usable
            AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93),
reach AS (SELECT r AS x, r AS y FROM good UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x),
class AS (SELECT x, min(vec_id) AS component_id FROM reach JOIN good ON good.r = reach.y GROUP BY x),
links AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM good JOIN class ON class.x = r LEFT JOIN links ON links.x = r
"""
