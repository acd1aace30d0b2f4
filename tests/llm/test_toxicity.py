"""Classifier chain: held-out accuracy, out-of-fold training, degenerate inputs."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from custmaster.llm import toxicity as L

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    models = L.train(docs, labels.where(~held))
    rows = (L.score(docs, models).join(labels.where(held), "doc_id")
            .groupBy("toxic", L.is_toxic(models).alias("said")).count().collect())
    n = {(r.toxic, r.said): r["count"] for r in rows}
    assert n.get((0, True), 0) <= 0.01 * n[0, False]                    # clean documents stay
    assert n[1, True] >= 0.8 * (n[1, True] + n.get((1, False), 0))


def test_the_chain_decides(tables):
    """The deciding model sees the others' probabilities; all three, recomputed in plain Python."""
    docs, labels = tables
    models = L.train(docs, labels)
    assert L.NAMES[-1] == "toxic" and [len(m.weights) - len(m.features) for m in models] == [0, 1, 2]
    assert np.abs(models[-1].weights[-2:]).max() > 0.1
    rows = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(20)) == 0).select("doc_id", "text").collect()
    got = {r.doc_id: r for r in L.digest(docs, labels).collect()}
    words = L._Words()
    for r in rows:
        own, chain = L.text_features(r.text or "", words), []
        for name, m in zip(L.NAMES, models):
            z = m.bias + sum(w for f, w in zip(m.features.tolist(), m.weights) if f in own)
            z += sum(w * x for w, x in zip(m.weights[len(m.features):], chain))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            assert abs(got[r.doc_id][f"p_{name}"] - p) < 1e-9
            chain.append(float(L._logit(np.array(p))))
        assert got[r.doc_id].rejected == (p >= models[-1].threshold)


def test_later_models_see_out_of_fold_probabilities(monkeypatch):
    seen = []
    real = L.Linear

    class Spy(real):
        def __init__(self, rows, chain, y):
            seen.append((len(rows), chain.copy()))
            super().__init__(rows, chain, y)

    monkeypatch.setattr(L, "Linear", Spy)
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 8)).astype("<i4") for _ in range(400)]
    noise = rng.random((400, 2)) < 0.2                                # else every view is the same clipped one
    y = np.array([[5 in r, 5 in r or 7 in r] for r in map(set, rows)], bool) ^ noise
    y = y.astype(float)
    models = L.fit_chain(np.arange(400), rows, y)
    assert len(models) == 2 and len(seen) == 2 * (L.FOLDS + 1)
    assert all(n < 400 for n, _ in seen[:L.FOLDS]) and seen[L.FOLDS][0] == 400
    chain = seen[-1][1][:, 0]                                            # what the second model was fitted on
    inside = L._logit(models[0].probabilities(rows, np.zeros((400, 0))))
    assert chain.shape == (400,) and not np.allclose(chain, inside)     # not the fitted model's own view


def test_odd_rows_and_clashing_columns(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (11, 0, 1), (None, 1, 1), (6, None, 1), (5, 0, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    models = L.train(odd, labels)
    rows = L.score(odd, models).collect()
    assert len(rows) == odd.count() and all(0 <= r.toxicity.toxic <= 1 for r in rows)


def test_no_labels_and_one_class(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    models = L.train(odd, none)
    assert L.score(odd, models).where(L.is_toxic(models)).count() == 0
    clean = spark.createDataFrame([(4, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    models = L.train(odd, clean)
    assert L.score(odd, models).where(L.is_toxic(models)).count() == 0
    assert L.digest(empty, none).count() == 0


def test_same_model_each_time(tables):
    docs, labels = tables
    a, b = L.train(docs, labels), L.train(docs.repartition(7), labels.repartition(3))
    assert all(np.array_equal(x.features, y.features) and np.allclose(x.weights, y.weights) for x, y in zip(a, b))


def test_rows_of_one_id_are_fitted_on_once(spark, docs_of, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    docs = docs_of([(i, f"text {i}") for i in range(20)] + [(7, f"later text {k}") for k in range(300)] + [(8, None)])
    got = []
    monkeypatch.setattr(L, "fit_chain", lambda ids, features, y: got.append((ids.tolist(), len(features), len(y))))
    L.train(docs, labels)
    assert got == [(list(range(20)), 20, 20)]
