"""Hard negatives by inner product, mined with cover trees over norm-augmented vectors.

Vectors are integers, floor(scale * x).  Augmented by sqrt(M - |x|^2), M the largest
squared norm, every vector x gets the same length, and the squared distance to a query q
(augmented by 0) is |q|^2 + M - 2 <q, x>: a ball around a node's centre bounds the inner
products of all its rows from above and below.

1. The top level: centres chosen farthest first from ``SAMPLE`` rows (the only thing
   that a sample is used for).  Every row goes to its nearest centre and its group of
   labels; groups are dealt into pieces of about ``TREE`` rows, by their counts.
2. Each piece becomes a cover tree, one file of the shared folder: a node's rows are covered
   by at most ``FANOUT`` of them, chosen farthest first, each with its covering radius,
   until ``LEAF`` rows or a radius of 0 are left.
3. Anchors (every row whose id is divisible by ``EVERY``) are stored in blocks of ``ANCHORS``.
   A task takes a block through some trees, best first: the node with the highest bound
   for any of the block's queries is opened next, for those queries that it can still serve.
   A node goes unopened where its bounds lie outside the query's window, below its
   k-th best score so far, or its labels do not fit.  Leaves are verified with exact integers.
4. First the positives are searched (same label, no window); their scores give
   the windows of the second search (other labels).  Per query and task at most k rows are
   returned and merged.

There are as many groups of trees a block as keep all tasks busy, so what is returned
grows with the anchors; what is computed is the part of anchors x rows that the
bounds leave.

Rows without id or label, with a null vector or with null or non-finite components
take no part.  A shorter vector counts as filled up with zeros.  Repeated rows, and rows of one id,
are rows of their own (an anchor's twin is another row).  Ties go to the smaller id.  A
positive score of 0 or less has an empty window unless scores are 0.  Empty tables
give empty results; other columns, whatever their names, are not read.  A component of 2^22 or more
in integers would not fit 64-bit scores: the job fails and says so.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import load_bytes, materialise, shared_path, store_bytes

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 10
LOW, HIGH = 30, 90  # a window, in hundredths of the positive's score
SAMPLE, CENTRES, LABEL_GROUPS = 4096, 256, 16
TREE, FANOUT, LEAF, ANCHORS = 16384, 16, 64, 1024
LIMIT = 1 << 22
_LEAST, _MOST = np.int64(-(1 << 62)), np.int64((1 << 63) - 1)


# -- rows ---------------------------------------------------------------------------------

def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the rows that take part, in integers, labels as they are."""
    def whole(x):
        return F.when(F.abs(x.cast("double")) * scale < LIMIT, F.floor(x.cast("double") * F.lit(float(scale)))).otherwise(
            F.raise_error(F.lit("a component is too large for 64-bit scores")).cast("bigint"))

    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", whole).alias("v"))


def _matrix(v: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Integer rows of length ``dim``, shorter ones filled up with zeros."""
    if isinstance(v, pa.ChunkedArray):
        v = v.combine_chunks()
    length = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(v), dim), np.int32)
    out[np.arange(dim) < length[:, None]] = v.flatten().to_numpy()
    return out


def _augmented(v: np.ndarray, top: int) -> np.ndarray:
    x = v.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(top - (x ** 2).sum(1), 0))])


def _distance(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(1))


def farthest_first(x: np.ndarray, first: int, count: int) -> tuple[list[int], np.ndarray]:
    """Up to ``count`` rows, each the farthest from those before; and each row's nearest of them."""
    chosen, nearest = [first], np.zeros(len(x), np.int64)
    least = _distance(x, x[first])
    while len(chosen) < count and least.max() > 0:
        chosen.append(int(least.argmax()))
        d = _distance(x, x[chosen[-1]])
        closer = d < least
        nearest[closer], least[closer] = len(chosen) - 1, d[closer]
    return chosen, nearest


# -- trees --------------------------------------------------------------------------------

class Tree:
    """Rows in the order of the leaves and nodes by level: centre (a row), covering radius,
    rows [begin, end), children [child, child + children), least and greatest label."""

    FIELDS = ("v", "ids", "labels", "rows", "centre", "radius", "span", "child", "label_span")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, v: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, top: int) -> Tree:
        x = _augmented(v, top)
        order = np.arange(len(x))
        centre, radius, span, child = [0], [], [(0, len(x))], []
        at = 0
        while at < len(centre):  # level by level: children are appended together
            begin, end = span[at]
            own = order[begin:end].copy()
            radius.append(_distance(x[own], x[centre[at]]).max())
            if end - begin <= LEAF or radius[at] == 0:
                child.append((0, 0))
            else:
                chosen, nearest = farthest_first(x[own], int(np.flatnonzero(own == centre[at])[0]), FANOUT)
                order[begin:end] = own[np.argsort(nearest, kind="stable")]
                ends = begin + np.cumsum(np.bincount(nearest, minlength=len(chosen)))
                child.append((len(centre), len(chosen)))
                centre += [int(own[c]) for c in chosen]
                span += list(zip([begin, *ends[:-1].tolist()], ends.tolist()))
            at += 1
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        labels = labels[order]
        spans = [(labels[b:e].min(), labels[b:e].max()) for b, e in span]
        return cls(v=v[order], ids=ids[order], labels=labels, rows=rows[order], centre=place[centre],
                   radius=np.array(radius), span=np.array(span), child=np.array(child), label_span=np.array(spans))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, uri: str) -> Tree:
        with np.load(io.BytesIO(load_bytes(uri))) as z:
            return cls(**{f: z[f] for f in cls.FIELDS})


class Queries:
    """A block's queries: for each its anchor, a window of scores, and the best found."""

    def __init__(self, v: np.ndarray, labels: np.ndarray, rows: np.ndarray, anchor: np.ndarray,
                 low: np.ndarray, high: np.ndarray, k: int, same: bool, top: int):
        self.kind = float if top < 1 << 53 else np.int64  # sums of products are exact in either
        self.v, self.labels, self.rows = v.astype(self.kind), labels, rows
        self.norm = (v.astype(float) ** 2).sum(1)
        self.anchor, self.low, self.high, self.k, self.same, self.top = anchor, low, high, k, same, top
        self.score = np.full((len(anchor), k), _LEAST)
        self.found = np.full((len(anchor), k), _MOST)
        self.visited = 0  # rows verified

    def wanted(self) -> np.ndarray:
        """The least score that can still enter a query's result."""
        return np.maximum(self.low, self.score[:, -1])

    def _bounds(self, tree: Tree, nodes: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of the nodes' inner products (anchors x nodes)."""
        product = self.v[anchors].astype(float) @ tree.v[tree.centre[nodes]].T.astype(float)
        both = self.norm[anchors, None] + self.top
        d = np.sqrt(np.maximum(both - 2 * product, 0))
        slack = 1e-9 * both + 1
        r = tree.radius[nodes]
        return (both - np.maximum(d - r, 0) ** 2) / 2 + slack, (both - (d + r) ** 2) / 2 - slack

    def descend(self, tree: Tree) -> None:
        everyone = np.arange(len(self.anchor))
        heap = []

        def push(nodes: np.ndarray, queries: np.ndarray, limit: np.ndarray) -> None:
            anchors, at = np.unique(self.anchor[queries], return_inverse=True)
            upper, lower = self._bounds(tree, nodes, anchors)
            wanted = self.wanted()[queries]
            label = self.labels[self.anchor[queries]]
            for i, node in enumerate(nodes.tolist()):
                least, greatest = tree.label_span[node]
                fits = ((least <= label) & (label <= greatest)) if self.same else ~((least == label) & (label == greatest))
                bound = np.minimum(upper[at, i], limit)
                use = np.flatnonzero(fits & (bound >= wanted) & (lower[at, i] <= self.high[queries]))
                if len(use):
                    heapq.heappush(heap, (-bound[use].max(), node, queries[use], bound[use]))

        if len(everyone):
            push(np.array([0]), everyone, np.full(len(everyone), np.inf))
        while heap:
            _, node, queries, bound = heapq.heappop(heap)
            use = bound >= self.wanted()[queries]
            if not use.any():
                continue
            child, children = tree.child[node]
            if children:
                push(np.arange(child, child + children), queries[use], bound[use])
            else:
                begin, end = tree.span[node]
                for at in range(begin, end, 512):  # a leaf of equal rows may be long
                    self._verify(tree, slice(at, min(at + 512, end)), queries[use])

    def _verify(self, tree: Tree, rows: slice, queries: np.ndarray) -> None:
        anchors, at = np.unique(self.anchor[queries], return_inverse=True)
        scores = (self.v[anchors] @ tree.v[rows].astype(self.kind).T).astype(np.int64)
        self.visited += scores.size
        fits = (self.labels[anchors, None] == tree.labels[rows]) == self.same
        fits &= self.rows[anchors, None] != tree.rows[rows]
        own = scores[at]
        fits = fits[at] & (own >= self.wanted()[queries, None]) & (own <= self.high[queries, None])
        hit = np.flatnonzero(fits.any(1))
        if not len(hit):
            return
        who = queries[hit]
        score = np.concatenate([self.score[who], np.where(fits[hit], own[hit], _LEAST)], axis=1)
        found = np.concatenate([self.found[who], np.where(fits[hit], tree.ids[rows], _MOST)], axis=1)
        best = np.lexsort((found, -score), axis=1)[:, :self.k]
        self.score[who] = np.take_along_axis(score, best, 1)
        self.found[who] = np.take_along_axis(found, best, 1)

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of what was found."""
        query, place = np.nonzero(self.score > _LEAST)
        return query, self.found[query, place], self.score[query, place]


# -- the index ----------------------------------------------------------------------------

def _nearest_centre(centres: np.ndarray, dim: int, top: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _augmented(_matrix(part.column("v"), dim), top)
                nearest = (-2 * (x @ centres.T) + (centres ** 2).sum(1)).argmin(1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nearest.astype(np.int32))],
                                                 names=[*part.schema.names, "centre"])

    return assign


def _write_tree(root: str, dim: int, top: int):
    def write(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        tree = Tree.build(_matrix(rows.column("v"), dim), *(rows.column(c).to_numpy() for c in ("vec_id", "label", "row")), top)
        name = rows.column("tree")[0].as_py()
        store_bytes(f"{root}/tree-{name}", tree.dump())
        return pa.table({"tree": pa.array([name], pa.int64()), "members": pa.array([rows.num_rows], pa.int64())})

    return write


class Index:
    """Cover trees in the shared folder over all rows of ``rows`` (row, vec_id, label, v)."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        squares = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
        n, dim, top = rows.agg(F.count("*"), F.max(F.size("v")), F.max(squares)).first()
        self.dim, self.top, self.root = dim or 0, top or 0, shared_path(spark, "cover-trees")
        sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").toArrow()
        x = _augmented(_matrix(sample.column("v"), self.dim), self.top)
        centres = x[farthest_first(x, 0, min(CENTRES, 1 + n // (LABEL_GROUPS * TREE)))[0]] if n else x
        # labels only decide which rows share a tree: groups of them, whatever their number
        assigned = rows.mapInArrow(_nearest_centre(centres, self.dim, self.top),
                                   "row bigint, vec_id bigint, label bigint, v array<bigint>, centre int")
        assigned = assigned.withColumn("part", F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)) * len(centres) + F.col("centre"))
        assigned = materialise(assigned.drop("centre"), "assigned")
        counts = {r.part: r["count"] for r in assigned.groupBy("part").count().collect()}  # LABEL_GROUPS x CENTRES at most
        pieces = [-(-counts.get(p, 0) // TREE) for p in range(max(counts, default=0) + 1)]
        first = [sum(pieces[:p]) for p in range(len(pieces))]

        def of_part(values: list[int]):
            return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), (F.col("part") + 1).cast("int"))

        tree = of_part(first) + F.pmod(F.xxhash64("row"), of_part([max(p, 1) for p in pieces]))
        self.trees = materialise(assigned.withColumn("tree", tree).drop("part").groupBy("tree").applyInArrow(
            _write_tree(self.root, self.dim, self.top), "tree bigint, members bigint"), "trees")

    def search(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """(row, query, found, score): for each anchor (row, label, v, low, high: arrays of its queries'
        windows) at most ``k`` rows a task; the best ``k`` of all tasks are the result."""
        spark = anchors.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        root = shared_path(spark, "anchors")
        blocks = max(1, -(-anchors.count() // (ANCHORS // 2)))
        groups = max(1, -(-2 * parts // blocks))
        written = materialise(anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).groupBy("block")
                              .applyInArrow(_write_anchors(root, self.dim), "block bigint"), "anchor-blocks")
        dealt = self.trees.groupBy(F.pmod(F.xxhash64("tree"), F.lit(groups)).alias("part")).agg(
            F.sort_array(F.collect_list("tree")).alias("trees"))
        work = dealt.select("part", "trees", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("block"))
        work = work.join(written, "block", "left_semi").select("block", "part", "trees").repartition(parts, "block", "part")
        return work.mapInArrow(_searched(self.root, root, self.top, k, same),
                               "row bigint, query int, found bigint, score bigint")


def _write_anchors(root: str, dim: int):
    def write(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        out = io.BytesIO()
        low = rows.column("low").combine_chunks()
        np.savez(out, v=_matrix(rows.column("v"), dim), labels=rows.column("label").to_numpy(), rows=rows.column("row").to_numpy(),
                 queries=np.diff(low.offsets.to_numpy()), low=low.flatten().to_numpy(),
                 high=rows.column("high").combine_chunks().flatten().to_numpy())
        block = rows.column("block")[0].as_py()
        store_bytes(f"{root}/anchors-{block}", out.getvalue())
        return pa.table({"block": pa.array([block], pa.int64())})

    return write


def _searched(trees: str, root: str, top: int, k: int, same: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, names in zip(batch.column("block").to_pylist(), batch.column("trees").to_pylist()):
                with np.load(io.BytesIO(load_bytes(f"{root}/anchors-{block}"))) as z:
                    anchor = np.repeat(np.arange(len(z["rows"])), z["queries"])
                    number = np.arange(len(anchor)) - np.repeat(np.cumsum(z["queries"]) - z["queries"], z["queries"])
                    rows = z["rows"]
                    queries = Queries(z["v"], z["labels"], rows, anchor, z["low"], z["high"], k, same, top)
                for name in names:
                    queries.descend(Tree.load(f"{trees}/tree-{name}"))
                query, found, score = queries.results()
                yield pa.RecordBatch.from_arrays([pa.array(rows[anchor[query]]), pa.array(number[query].astype(np.int32)),
                                                  pa.array(found), pa.array(score)], names=["row", "query", "found", "score"])

    return search


# -- the operator -------------------------------------------------------------------------

def _best(found: DataFrame, k: int) -> DataFrame:
    """(row, query, best): the first ``k`` by score, ties by id (at most k a task come together)."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("cost"), "found")))
    return found.groupBy("row", "query").agg(F.slice(ranked, 1, k).alias("best"))


def _all(bound: np.int64) -> Column:
    return F.array(F.lit(int(bound)).cast("bigint"))


def hard_negatives(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``rows`` (vec_id, label, v)."""
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v"), "integers")
    index = Index(rows)
    anchors = rows.where(F.col("vec_id") % every == 0)

    same = index.search(anchors.select("row", "label", "v", _all(_LEAST).alias("low"), _all(_MOST).alias("high")),
                        positives, True)
    chosen = materialise(anchors.join(_best(same, positives).select("row", "best"), "row"), "positives")
    # the window in integers: the least score s with 100 s >= low p, the greatest with 100 s <= high p
    hundred = F.lit(100).cast("bigint")

    def down(x):
        return F.call_function("div", x - F.pmod(x, hundred), hundred)

    lows = F.transform("best", lambda p: -down(p["cost"] * low))
    highs = F.transform("best", lambda p: down(-p["cost"] * high))
    other = index.search(chosen.select("row", "label", "v", lows.alias("low"), highs.alias("high")),
                         negatives, False)
    told = chosen.select("row", F.col("vec_id").alias("anchor_id"), F.posexplode("best").alias("query", "positive"))
    best = _best(other, negatives).select("row", "query", F.posexplode("best").alias("place", "negative"))
    return told.join(best, ["row", "query"]).select(
        "anchor_id", F.col("positive.found").alias("positive_id"), (F.col("place") + 1).cast("int").alias("rank"),
        F.col("negative.found").alias("negative_id"), (-F.col("positive.cost")).alias("positive_score"),
        (-F.col("negative.cost")).alias("negative_score"))


def digest(vectors: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(prepared(vectors).withColumn("label", label))


#: The digest in SQL: every anchor against every row. Only for tables of test size.
ORACLE_SQL = """
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_resize(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)),
                     (SELECT max(len(embedding)) FROM embeddings), 0.0) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positive AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS p FROM scored WHERE same QUALIFY p <= 5),
negative AS (
  SELECT p.a, p.p, p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM positive p JOIN scored n ON n.a = p.a AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 10
"""
