"""Centroid clustering: SQL parity on odd vectors, a brute-force version, native plans, bounded results."""
import hashlib

import numpy as np
import pytest

from custmaster.llm import centroids
from custmaster.llm.common import table


def test_odd_vectors(odd_vecs, by_sql):
    kept = odd_vecs.where("vec_id IS NOT NULL")
    assert by_sql(centroids.digest(kept), kept, centroids.ORACLE_SQL) > 150


def test_null_ids_start_last(vecs_of):
    df = vecs_of([(None, [float(i)] * 64, 0) for i in range(30)] + [(i, [100.0 + i] * 64, 0) for i in range(10)])
    found = centroids.digest(df).collect()
    assert len(found) == 40 and len({r.cluster for r in found}) == 16
    starts = centroids.starts(centroids.quantised(df))
    assert sorted(s[0] // 64 >= 100 for s in starts[:10]) == [True] * 10


def _plain(rows, k, rounds):
    kept = [(i, np.floor(64 * np.array(e, np.float32).astype(float)).astype(int)) for i, e in rows]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())
    centres = [v for _, v in order[:k]]

    def assign():
        d = [[int(((v - c) ** 2).sum()) for c in centres] for _, v in kept]
        return [(min(range(len(x)), key=lambda j: (x[j], j)), min(x)) for x in d]

    for _ in range(rounds):
        to = [a for a, _ in assign()]
        for j in range(len(centres)):
            own = [v for (_, v), t in zip(kept, to) if t == j]
            if own:
                centres[j] = np.array([sum(int(v[d]) for v in own) // len(own) for d in range(64)])
    return {i: a for (i, _), a in zip(kept, assign())}, centres


def test_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    expected, centres = _plain([(r.vec_id, r.embedding) for r in df.collect()], 16, 3)
    found, ours = centroids.cluster(df)
    assert [list(map(int, c)) for c in centres] == ours
    assert {r.vec_id: (r.cluster, r.distance) for r in found.collect()} == expected


def test_hot_cluster_moves_k_rows_a_task(spark, vecs_of):
    df = vecs_of([(i, [0.5] * 64, 0) for i in range(3000)] + [(5000 + i, [i / 100] * 64, 0) for i in range(50)])
    kept = centroids.quantised(df.repartition(8)).cache()
    sums = centroids.column_sums(kept, centroids.starts(kept))
    rows = sums.collect()
    assert sum(r.n for r in rows) == 3050
    plan = sums._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # whole-stage code for the column sums, a partial sum before the shuffle, no Python
    assert plan.count(") HashAggregate") == 2 and "partial_sum" in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_and_few(no_vecs, vecs_of):
    assert centroids.digest(no_vecs).collect() == []
    few = centroids.digest(vecs_of([(1, [0.1] * 64, 0), (2, [0.9] * 64, 0), (3, [0.1] * 63, 0)])).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in few) == [(1, 0, 0), (2, 0, 0)]
    assert len({r.cluster for r in few}) == 2


def test_too_large_says_so(vecs_of):
    with pytest.raises(Exception, match="too large"):
        centroids.digest(vecs_of([(1, [1e30] * 64, 0)])).collect()
