"""Centroid clustering in integers, with JVM-native expressions only.

1. ``quantised`` keeps vectors of exactly ``dim`` components, none null or
   non-finite, as arrays of floor(scale * x), and writes them once.
2. Centroids 0, 1, ... start as the ``k`` kept vectors with the smallest
   sha256 of ``<seed>:<vec_id>``.
3. In a round the centroids are literal arrays of the plan: ``zip_with`` and
   ``aggregate`` give a vector's squared distance to each, ``array_min`` over
   (distance, number) structs chooses the nearest (ties: the smaller number),
   and one partial aggregate per task sums the columns.  A shuffle carries
   ``k`` rows of each task, whatever the clusters' sizes; the driver gets
   ``k`` rows of sums and divides them exactly.
4. After the rounds vectors are assigned once more and the assignment is
   written; inertias are sums over it.

The rounds depend on each other by ``k`` literals only, so there is no
lineage to cut but the written vectors.

Null vectors, other lengths (empty ones too) and null or non-finite components
take no part.  A row without id is assigned like any other and starts a
centroid only after all rows with one.  Repeated rows and ids are rows of their
own; of equal ids the lesser vector comes first as a start.  Fewer than ``k``
vectors give as many centroids; an empty table gives an empty result.  Other
columns of the table, whatever their names, are not read.  An integer of 2^26
or more would not fit the 64-bit distance: the job fails and says so.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import materialise

DIM, K, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
LIMIT = 1 << 26


def quantised(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors that take part, in integers."""
    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x.cast("double")) * scale < LIMIT, y).otherwise(
            F.raise_error(F.lit("a component is too large for 64-bit distances")).cast("bigint"))

    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size("embedding") == dim) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def starts(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The vectors of the smallest hashes (k rows on the driver)."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in vectors.orderBy(hashed.asc_nulls_last(), "v").select("v").limit(k).collect()]


def distance(v: Column, centroid: list[int]) -> Column:
    literal = F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")
    return F.aggregate(F.zip_with(v, literal, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"),
                       lambda s, x: s + x)


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid."""
    return F.array_min(F.array(*[F.struct(distance(v, c).alias("distance"), F.lit(i).alias("cluster"))
                                 for i, c in enumerate(centroids)]))


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    return vectors.withColumn("nearest", nearest(F.col("v"), centroids))


def column_sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, n, s0, s1, ...): a round's sums, a row for each non-empty cluster."""
    return assigned(vectors, centroids).groupBy(F.col("nearest.cluster").alias("cluster")).agg(
        F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))])


def updated(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round; those of empty clusters stay."""
    out = list(centroids)
    for row in column_sums(vectors, centroids).collect():
        out[row.cluster] = [s // row.n for s in row[2:]]
    return out


def cluster(vectors: DataFrame, dim: int = DIM, k: int = K, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of the vectors that take part, and the final centroids."""
    kept = materialise(quantised(vectors, dim, scale), "integers")
    centroids = starts(kept, k, seed)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = updated(kept, centroids)
    final = assigned(kept, centroids).select("vec_id", "nearest.cluster", "nearest.distance")
    return materialise(final, "assignment"), centroids


def digest(vectors: DataFrame) -> DataFrame:
    found, centroids = cluster(vectors)
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}

    def of_cluster(values: list, kind: str) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values or [None]])[F.col("cluster")]

    return found.select(
        "vec_id", "cluster", "distance",
        of_cluster([sums.get(i) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        of_cluster([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids], "string")
        .alias("centroid_sha256"))


def _oracle(dim: int, k: int, rounds: int, scale: int, seed: int) -> str:
    parts = [f"""
kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
         FROM embeddings WHERE len(embedding) = {dim}
           AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS cluster, v AS c
       FROM kept QUALIFY cluster < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS (SELECT r, vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
           SELECT kept.*, cluster, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
           FROM kept, c{i}) GROUP BY r, vec_id, v)""")
        if i < rounds:
            parts.append(f"""
u{i} AS (SELECT cluster, list(m ORDER BY pos) AS c FROM (
           SELECT cluster, pos, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS m
           FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {dim + 1})) AS pos FROM a{i}) GROUP BY cluster, pos)
         GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(u{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN u{i} USING (cluster))""")
    return f"""WITH {','.join(parts)}
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


ORACLE_SQL = _oracle(DIM, K, ROUNDS, SCALE, SEED)
