"""Lattice hashing: the decoder against brute force, SQL parity on odd vectors, recall, hot cells."""
import numpy as np
import pytest

from custmaster.llm import lattice
from custmaster.llm.components import components, roots


def test_neighbours_are_shortest():
    n = lattice.neighbours()
    assert n.shape == (240, 8) and len(np.unique(n, axis=0)) == 240
    assert np.allclose((n ** 2).sum(1), 2) and np.array_equal(lattice.decode(n), n)


def test_decode_is_nearest():
    x = np.random.default_rng(3).normal(size=(2000, 8)) * 2
    own = lattice.decode(x)
    d = ((x - own) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all()  # the covering radius of E8 is 1
    for r in lattice.neighbours():  # no neighbour is nearer: a lattice point's Voronoi facets are these
        assert (d <= ((x - own - r) ** 2).sum(1) + 1e-9).all()


def test_odd_vectors(odd_vecs, by_sql):
    assert by_sql(lattice.digest(odd_vecs), odd_vecs, lattice.ORACLE_SQL) == odd_vecs.count()


def test_empty(no_vecs):
    assert lattice.digest(no_vecs).collect() == []


def test_plan_keeps_recall():
    for rows in (100, 10_000, 30_000_000):
        how = lattice.plan(rows)
        assert 1 - (1 - lattice.hit_rate(how.scale)) ** how.tables >= lattice.RECALL
        assert rows * (np.pi / 2 * how.scale ** 2) ** -4 <= lattice.CELL or how.scale == lattice.LEAST_SCALE


def _pairs_at(cosine, n, seed=11):
    rng = np.random.default_rng(seed)
    a, b = rng.standard_normal((2, n, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    return a, cosine * a + (1 - cosine ** 2) ** .5 * b / np.linalg.norm(b, axis=1)[:, None]


def test_recall_near_the_threshold(vecs_of):
    a, b = _pairs_at(0.9301, 400)
    c, d = _pairs_at(0.9299, 400, 12)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b, c, d]))]
    got = {r.vec_id: r for r in lattice.digest(vecs_of(rows)).collect()}
    found = sum(got[i].component_id == got[400 + i].component_id for i in range(400))
    assert found >= 0.99 * 400
    assert all(got[i].n_links == 0 and got[i].kept for i in range(800, 1600))


@pytest.mark.parametrize("block", [16, 100_000])
def test_hot_group(spark, vecs_of, monkeypatch, block):
    """A third of all rows near copies of one vector: counted whole, block by block or at once."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 64))
    x[:120] = x[0] + rng.standard_normal((120, 64)) * 0.3  # around the threshold
    x = x.astype("float32")
    monkeypatch.setattr(lattice, "BLOCK", block)
    got = {r.vec_id: r for r in lattice.digest(vecs_of([(i, v.tolist(), 0) for i, v in enumerate(x)])).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    link = u @ u.T >= lattice.THRESHOLD
    np.fill_diagonal(link, False)
    a, b = np.nonzero(link)
    degree, root = link.sum(1), roots(300, a, b)
    assert 0 < degree.sum() < 120 * 119
    ours = np.array([got[i].n_links for i in range(300)])
    assert (ours <= degree).all() and ours.sum() >= 0.99 * degree.sum()
    assert np.mean([got[i].component_id == root[i] for i in range(300)]) >= 0.99


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 100 + i) for i in range(60)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(51)} == {0} and {got[i] for i in [1000, *range(100, 160)]} == {100}
