"""N-gram Jaccard join against all pairs; pruning and components against plain versions."""
import random
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from custmaster.llm import ngram_join as L
from custmaster.llm.components import components, roots


def plain(rows):
    """doc_id: (class, links) of rows (doc_id, text) with ids, by comparing all pairs."""
    sets = {i: set(L.shingles((t or "").encode()).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if (not x and not y) or (x and y and 5 * len(x & y) >= 4 * len(x | y)):
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (find(i), links[i]) for i in ids}


def near_copies(seed, n, words=60, change=6):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randrange(change)):
            own[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in L.near_classes(df).collect()}
    assert got == plain(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])


def test_groups(spark):
    texts = near_copies(1, 60) + near_copies(2, 25, 30, 3) + near_copies(3, 40, 200, 20) + ["", None, " ", "a b", "a b", "a  b"]
    check(spark, list(enumerate(texts)))


def test_blocks_of_a_large_group(spark, monkeypatch):
    # the driver plans the blocks; workers only follow the units they are given
    monkeypatch.setattr(L, "BLOCK", 7)
    check(spark, list(enumerate(near_copies(5, 90, 50, 4))))


def test_texts_of_one_id_are_apart(docs_of):
    """A unique text stays, whatever its id's other rows are."""
    a, b = near_copies(8, 1)[0], near_copies(9, 1)[0]
    rows = [(3, a), (5, a), (5, b)]
    assert sorted((r.doc_id, r.text) for r in L.keep_one(docs_of(rows)).collect()) == sorted([(3, a), (5, b)])
    got = {(r.doc_id, r.class_id, r.copy_of, r.n_links) for r in L.near_classes(docs_of(rows)).collect()}
    assert got == {(3, 3, 3, 1), (5, 3, 3, 1), (5, 5, 5, 0)}


def test_one_of_a_class_whose_ids_tie(docs_of):
    near = near_copies(4, 6, 200, 3)
    rows = [(5, t) for t in near] + [(5, " " + near[0]), (6, near[0])] * 2
    assert len(L.keep_one(docs_of(rows)).collect()) == 1


def test_hot_repeated_row(docs_of):
    near = near_copies(4, 5, 200, 3)
    rows = [(1, near[0])] * 300 + [(i, t) for i, t in enumerate(near, 2)]
    got = L.near_classes(docs_of(rows)).collect()
    assert len(got) == 305 and {(r.class_id, r.n_links) for r in got} == {(1, 5)}
    assert [r.doc_id for r in L.keep_one(docs_of(rows)).collect()] == [1]


def test_odd_rows(odd, empty):
    rows = L.near_classes(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, r)
    assert by[6].class_id == by[7].class_id == 6 and by[6].n_links == 1
    assert by[11].class_id == by[12].class_id == 11
    assert by[1].class_id == by[2].class_id == by[3].class_id == 1 and by[4].n_links == 0
    assert by[None].class_id is None
    assert L.near_classes(empty).count() == 0


def test_keep_one(odd, empty):
    kept = L.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 4, 5, 6, 8, 9, 10, 11, 13, 13, 14, 15, None]
    assert L.keep_one(empty).count() == 0


def test_repeated_rows_leave_one(docs_of):
    kept = L.keep_one(docs_of([(1, "the same row twice here"), (1, "the same row twice here"), (None, "no id"), (None, "no id")]))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "the same row twice here"), ("None", "no id")]


def test_posterior_and_least_matches():
    assert L.chance(16, 16) > 0.97 and L.chance(0, 16) < 1e-9
    for n in L.STEPS:
        m = L.least_matches(n)
        assert L.chance(m, n) >= L.TOLERANCE and (m == 0 or L.chance(m - 1, n) < L.TOLERANCE)


def test_pruning_keeps_what_the_threshold_keeps():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 60000, L.VALUES)
    left = np.stack([np.where(rng.random(L.VALUES) < p, base, rng.integers(0, 60000, L.VALUES))
                     for p in np.linspace(0, 1, 150)]).astype("<u2")
    a, b = L.surviving(left, left, True)
    pairs = set(zip(a.tolist(), b.tolist()))
    want = set()
    for i in range(150):
        for j in range(i + 1, 150):
            same = left[i] == left[j]
            if all(same[:n].sum() >= L.least_matches(n) for n in L.STEPS):
                want.add((i, j))
    assert pairs == want and pairs


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_roots(edges):
    a, b = (np.array([e[k] for e in edges], int) for k in (0, 1))
    root = roots(31, a, b)
    label = list(range(31))
    for _ in range(31):
        for x, y in edges:
            label[x] = label[y] = min(label[x], label[y])
    assert root.tolist() == label


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rnd.randrange(30), 100 + rnd.randrange(30)) for _ in range(25)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in range(60):
        for x, y in edges:
            label[x] = label[y] = min(label[x], label[y])
    assert got == {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
