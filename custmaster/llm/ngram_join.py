"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles (64-bit hashes); two are linked if the
Jaccard similarity of their sets is 0.8 or more.

1. ``sketches`` gives every document the hash of its shingle set and a MinHash
   signature of 128 values.  Documents with equal sets are copies: one of them
   stands for all from here on, so a group of copies, of whatever size, costs
   one row.
2. Signatures are cut into 32 bands of 4 values.  Only buckets (equal bands)
   with two members or more go on; a pair at the threshold misses all of them
   with a probability of 5e-8.
3. In a bucket, pairs are compared some MinHash values at a time and dropped
   once the posterior probability (uniform prior) that their similarity reaches
   the threshold falls below ``TOLERANCE``.  A bucket's surviving pairs are not
   emitted: it gives one edge for each member, to the least member that the
   survivors connect it with.
4. The edges' components, found by large-star and small-star rounds over
   written tables, are the groups that pairs are verified in: every member's
   exact set is sent to its group once, pairs are pruned as before, and the
   survivors' Jaccard similarity is computed exactly.

Buckets and groups of more than ``BLOCK`` members are dealt into blocks (``blocks``):
a block is written once and read for each pair of blocks, so what is shuffled grows
with the members; no task sees more than two blocks, no member is capped or
skipped, and pairs exist only inside a unit, as numbers of a matrix.  Results are
rows of documents: links are counted, not listed.

The nodes of buckets, groups and classes are sets, not ids: an id on rows with
different texts has a class for each of them.

A text of one to four words has one shingle, all of it; very long texts are whole
sets like any other.  Null text reads as empty; texts without words are copies of
each other and linked to nothing else.  Repeated rows of an id and text count as
one document.  A row without id takes the class of a copy that has one, and none
otherwise.  Ties go to the least id.  Empty tables give empty results; other columns,
whatever their names, are not read (``keep_one`` returns them).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.blocks import compare_units
from custmaster.llm.common import free_name, materialise
from custmaster.llm.components import SALTS, components, roots

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
VALUES, BAND = 128, 4
BANDS = VALUES // BAND
TOLERANCE = 1e-7
STEPS = (16, 32, 64, 128)
BLOCK = 512
_CACHE_WORDS = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 13


# -- shingles and signatures -------------------------------------------------------------

class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, n)
    width = min(SHINGLE, n)
    out = h[:n - width + 1].copy()
    for j in range(1, width):
        out = _finish(out) + h[j:n - width + 1 + j]
    return np.unique(_finish(out + np.uint64(width)))


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    seeds = np.array([[xxhash.xxh64_intdigest(f"{i}.{j}") for j in range(2)] for i in range(VALUES)], np.uint64)
    return seeds[:, 0] | np.uint64(1), seeds[:, 1]


def signature(values: np.ndarray) -> np.ndarray:
    """MinHash values of a set of hashes, 16 bits of each."""
    a, b = _permutations()
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), _CHUNK):
        part = values[at:at + _CHUNK, None] * a
        part += b
        np.minimum(low, part.min(axis=0), out=low)
    return (_finish(low) >> np.uint64(40)).astype("<u2")


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, signs, sizes = [], [], []
        texts = batch.column(2).cast(pa.binary())
        for i in range(batch.num_rows):
            own = shingles(texts[i].as_py() or b"")
            keys.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63))
            sizes.append(len(own))
            signs.append(signature(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()),
             pa.array(signs, pa.binary())], names=["doc_id", "text_key", "set_key", "size", "signature"])


def text_key() -> Column:
    """A row's text as a hash: with the id it tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, set_key, size, signature) of documents (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text").mapInArrow(
        _sketch_batches, "doc_id bigint, text_key bigint, set_key bigint, size int, signature binary")


# -- Bayesian pruning --------------------------------------------------------------------

def chance(matches: int, seen: int, threshold: float = float(THRESHOLD)) -> float:
    """Posterior probability (uniform prior) that the similarity reaches the threshold after
    ``matches`` of ``seen`` MinHash values were equal."""
    n = seen + 1
    return sum(comb(n, k) * threshold ** k * (1 - threshold) ** (n - k) for k in range(matches + 1))


@lru_cache(None)
def least_matches(seen: int) -> int:
    """The fewest equal values of ``seen`` that keep a pair."""
    return next(m for m in range(seen + 2) if chance(m, seen) >= TOLERANCE)


def surviving(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that the incremental comparison of signatures keeps;
    ``same``: both are one block, each pair once."""
    out_a, out_b = [], []
    for at in range(0, len(left), 64):
        part = left[at:at + 64]
        first = (part[:, None, :STEPS[0]] == right[None, :, :STEPS[0]]).sum(2)
        a, b = np.nonzero(first >= least_matches(STEPS[0]))
        if same:
            keep = a + at < b
            a, b = a[keep], b[keep]
        matches, seen = first[a, b], STEPS[0]
        for step in STEPS[1:]:
            if not len(a):
                break
            for cut in range(seen, step, 32):  # bounds the pairs' memory
                matches = matches + (part[a, cut:cut + 32 if cut + 32 < step else step]
                                     == right[b, cut:cut + 32 if cut + 32 < step else step]).sum(1)
            keep = matches >= least_matches(step)
            a, b, matches, seen = a[keep], b[keep], matches[keep], step
        out_a.append(a + at)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


# -- units of work -----------------------------------------------------------------------

def _survivors(left: pa.Table, right: pa.Table | None):
    """(rows of both blocks, rows of the pairs that survive)."""
    rows = left if right is None else pa.concat_tables([left, right])
    signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u2").reshape(-1, VALUES)
    n = left.num_rows
    a, b = surviving(signs[:n], signs[:n] if right is None else signs[n:], right is None)
    return rows, a, b if right is None else b + n


def _bucket_edges(left: pa.Table, right: pa.Table | None) -> pa.Table:
    """An edge of each member to the least one that the survivors connect it with."""
    rows, a, b = _survivors(left, right)
    node = rows.column("node").to_numpy()
    root = roots(len(node), a, b)
    moved = np.flatnonzero(root != np.arange(len(node)))
    return pa.table({"a": node[moved], "b": node[root[moved]]})


def _verified(left: pa.Table, right: pa.Table | None) -> pa.Table | None:
    """(node, links, root) per member of a unit that has links: linked documents, copies counted."""
    num, den = THRESHOLD.numerator, THRESHOLD.denominator
    rows, a, b = _survivors(left, right)
    if not len(a):
        return None
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
    size = np.array([len(x) for x in sets])
    ends = np.cumsum(size)
    vocabulary, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    shared = np.zeros(len(a), np.int64)
    marked = np.zeros(len(vocabulary), bool)
    firsts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    for lo, hi in zip(firsts, [*firsts[1:], len(a)]):
        own = place[ends[a[lo]] - size[a[lo]]:ends[a[lo]]]
        marked[own] = True
        for k in range(lo, hi):
            shared[k] = np.count_nonzero(marked[place[ends[b[k]] - size[b[k]]:ends[b[k]]]])
        marked[own] = False
    linked = den * shared >= num * (size[a] + size[b] - shared)
    a, b = a[linked], b[linked]
    node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
    links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
    root = roots(len(node), a, b)
    has = np.flatnonzero(links)
    return pa.table({"node": node[has], "links": links[has].astype(np.int64), "root": node[root[has]]})


# -- the join ----------------------------------------------------------------------------

def _member_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, copies, unit, members) with the signature and the exact set of the text."""
    for batch in batches:
        sets, signs = [], []
        for text in batch.column(0).cast(pa.binary()):
            own = shingles(text.as_py() or b"")
            sets.append(own.tobytes())
            signs.append(signature(own).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(signs, pa.binary()), pa.array(sets, pa.binary())],
                                         names=["node", "copies", "unit", "members", "signature", "shingles"])


def _marked(docs: DataFrame) -> DataFrame:
    return materialise(sketches(docs), "marks")


def _classified(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(set_key, class, rep, copies, links): a row for each set of a document with an id; ``class`` is
    the least set_key connected by links, ``rep`` the least id with the set."""
    row = F.struct("doc_id", "text_key")
    # equal sets have equal sizes and signatures: any row's will do
    sets = materialise(marks.where("doc_id IS NOT NULL").groupBy("set_key").agg(
        F.min(row).alias("row"), F.count_distinct("doc_id").alias("copies"), F.first("size").alias("size"),
        F.first("signature").alias("signature")), "sets")

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("signature"), k * (2 * BAND) + 1, F.lit(2 * BAND))))
    bands = sets.where("size > 0").select("set_key", F.explode(keys).alias("bucket"))
    shared = materialise(bands.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "buckets")
    # all three grow with the documents: shuffled at every size, never broadcast
    hits = bands.join(shared.hint("merge"), "bucket").join(sets.select("set_key", "signature").hint("merge"), "set_key")
    edges = compare_units(hits.select(F.col("set_key").alias("node"), "signature", F.col("bucket").alias("unit"), "members"),
                          BLOCK, _bucket_edges, "a bigint, b bigint")

    groups = components(edges)
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    groups = groups.join(sizes, "component").join(sets, groups["node"] == sets["set_key"]).select(
        "node", F.col("component").alias("unit"), "members", "copies", "row.doc_id", "row.text_key")
    times = marks.groupBy("doc_id", "text_key").agg(F.count("*").alias("times")).where("times > 1")
    groups = materialise(groups.join(times, ["doc_id", "text_key"], "left"), "groups")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    texts = texts.join(groups.hint("merge"), ["doc_id", "text_key"])
    # repeated rows of a document meet as partial aggregates
    texts = texts.where("times IS NULL").unionByName(texts.where("times IS NOT NULL").dropDuplicates(["node"]))
    members = texts.select("text", "node", "copies", "unit", "members").mapInArrow(
        _member_sets, "node bigint, copies bigint, unit bigint, members bigint, signature binary, shingles binary")
    found = compare_units(members, BLOCK, _verified, "node bigint, links bigint, root bigint")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    near = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))

    return materialise(sets.select(F.col("set_key").alias("node"), F.col("row.doc_id").alias("rep"), "copies")
                       .join(links, "node", "left").join(near, "node", "left")
                       .select(F.col("node").alias("set_key"), F.coalesce("component", "node").alias("class"), "rep", "copies",
                               F.coalesce("links", F.lit(0).cast("long")).alias("links")), "classes")


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) per row: class_id is the least id connected with its
    set by links, copy_of the least id with an equal shingle set, n_links the number of
    other documents that its set is linked with (copies counted)."""
    marks = _marked(docs)
    sets = _classified(docs, marks)
    sets = sets.join(sets.groupBy("class").agg(F.min("rep").alias("class_id")), "class")
    # a set may be that of very many rows: they meet it in SALTS places
    spread = sets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    rows = marks.select("doc_id", "set_key", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    return rows.join(spread, ["set_key", "salt"], "left").select(
        "doc_id", "class_id", F.col("rep").alias("copy_of"),
        F.when(F.col("doc_id").isNull(), F.col("links") + F.col("copies"))
        .otherwise(F.col("links") + F.col("copies") - 1).alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class: of its rows the one with the least id (and
    least text hash), once.  A text whose set no other row is linked with always stays, also
    where its id is on other rows.  Rows without id stay, one of each text."""
    marks = _marked(docs)
    sets = _classified(docs, marks).select("set_key", "class")
    spread = sets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    rows = marks.where("doc_id IS NOT NULL").select(
        "doc_id", "text_key", "set_key", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    rows = rows.join(spread, ["set_key", "salt"]).select("class", F.struct("doc_id", "text_key").alias("row")).distinct()
    rows = materialise(rows, "class-rows")
    heads = rows.groupBy("class").agg(F.min("row").alias("head"), F.count("*").alias("rows")).where("rows > 1")
    spread = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    rest = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).join(spread, ["class", "salt"]).where("row <> head")
    name, text = free_name(docs, "dropped_id"), free_name(docs, "dropped_text")
    rest = rest.select(F.col("row.doc_id").alias(name), F.col("row.text_key").alias(text))
    kept = docs.join(rest, (docs["doc_id"] == F.col(name)) & (text_key() == F.col(text)), "left_anti")
    return kept.dropDuplicates(["doc_id", "text"])


def digest(docs: DataFrame) -> DataFrame:
    return near_classes(docs)


#: The digest in SQL: every pair that shares a shingle. Only for tables of test size.
ORACLE_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
sets AS (SELECT w.doc_id, count(shingle) AS n, coalesce(string_agg(shingle, chr(10) ORDER BY shingle), '') AS shingles
         FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
         WHERE 5 * c >= 4 * (p.n + q.n - c)
         UNION ALL
         SELECT p.doc_id, q.doc_id FROM sets p JOIN sets q ON p.n = q.n WHERE p.n = 0 AND p.doc_id <> q.doc_id),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
class AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
copies AS (SELECT shingles, min(doc_id) AS copy_of FROM sets GROUP BY shingles),
links AS (SELECT x AS doc_id, count(*) AS n FROM link GROUP BY x)
SELECT doc_id, class_id, copy_of, coalesce(links.n, 0)::BIGINT AS n_links
FROM sets JOIN class USING (doc_id) JOIN copies USING (shingles) LEFT JOIN links USING (doc_id)
"""
