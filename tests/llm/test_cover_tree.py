"""Hard negatives: SQL parity on odd vectors, sound trees and bounds, skipping, pieces and blocks."""
import numpy as np
import pytest

from custmaster.llm import cover_tree
from custmaster.llm.common import table


def test_odd_vectors(odd_vecs, by_sql):
    assert by_sql(cover_tree.digest(odd_vecs), odd_vecs, cover_tree.ORACLE_SQL) > 50


def test_empty(no_vecs, vecs_of):
    assert cover_tree.digest(no_vecs).collect() == []
    assert cover_tree.digest(vecs_of([(100, [1.0, 0.5], 0)])).collect() == []


def test_small_trees_and_blocks(spark, by_sql, monkeypatch):
    """Many pieces, centres and blocks give the same rows."""
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    monkeypatch.setattr(cover_tree, "TREE", 64)
    monkeypatch.setattr(cover_tree, "ANCHORS", 8)
    assert by_sql(cover_tree.digest(df), df, cover_tree.ORACLE_SQL) == 1000


def _clustered(n=4000, clusters=40, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, 16)) * 200
    return (centres[np.arange(n) % clusters] + rng.standard_normal((n, 16)) * 8).astype(np.int32)


def test_tree_covers_its_rows():
    v = _clustered()
    top = int((v.astype(int) ** 2).sum(1).max())
    tree = cover_tree.Tree.build(v, np.arange(4000), np.arange(4000) % 7, np.arange(4000), top)
    x = cover_tree._augmented(tree.v, top)
    assert sorted(tree.ids.tolist()) == list(range(4000))
    leaves = 0
    for node, (b, e) in enumerate(tree.span):
        assert b <= tree.centre[node] < e
        assert np.isclose(np.sqrt(((x[b:e] - x[tree.centre[node]]) ** 2).sum(1)).max(), tree.radius[node])
        first, n = tree.child[node]
        if n:  # children cover the node's rows without overlap, and are smaller balls or fewer rows
            assert [tuple(s) for s in tree.span[first:first + n]][0][0] == b and tree.span[first + n - 1][1] == e
            assert all(tree.span[first + i][1] == tree.span[first + i + 1][0] for i in range(n - 1))
        else:
            leaves += 1
            assert e - b <= cover_tree.LEAF or tree.radius[node] == 0
    assert leaves > 40


@pytest.mark.parametrize("low, high", [(None, None), (-20_000, 30_000), (400_000, 500_000)])
def test_search_is_exact_and_skips(low, high):
    v, labels = _clustered(), np.arange(4000) % 7
    top = int((v.astype(int) ** 2).sum(1).max())
    tree = cover_tree.Tree.build(v, np.arange(4000), labels, np.arange(4000), top)
    rows = np.arange(0, 4000, 100)
    low, high = (cover_tree._LEAST, cover_tree._MOST) if low is None else (low, high)
    q = cover_tree.Queries(v[rows], labels[rows], rows, np.arange(40), np.full(40, low), np.full(40, high), 5, False, top)
    q.descend(tree)
    scores = v[rows].astype(int) @ v.T.astype(int)
    for i, r in enumerate(rows):
        fits = [(-int(s), j) for j, s in enumerate(scores[i]) if labels[j] != labels[r] and low <= s <= high]
        want = sorted(fits)[:5]
        got = [(-int(s), int(f)) for s, f in zip(q.score[i], q.found[i]) if s > cover_tree._LEAST]
        assert got == want
    assert q.visited < 0.4 * 40 * 4000  # bounds leave out most of the rows


def test_equal_rows_make_a_leaf(vecs_of, by_sql):
    df = vecs_of([(i, [0.5, 0.25, -0.125], i % 2) for i in range(700)] + [(1000 + i, [0.3, 0.1, 0.0], 1) for i in range(50)])
    assert by_sql(cover_tree.digest(df), df, cover_tree.ORACLE_SQL) > 0
