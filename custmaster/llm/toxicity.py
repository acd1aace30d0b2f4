"""Toxicity by a classifier chain.

Categories are predicted one after another (``CATEGORIES``): a document is
toxic in otherwise sound prose; toxic within junk; toxic at all.  Each is a
linear (logistic) model over binary text features, and the later ones also see
the probabilities of the earlier; the last one, which sees both others, decides
what is rejected.  While training, those are out-of-fold
predictions: every labelled row's earlier probability comes from a model that
has not seen it, so the later models learn from values like those they get at
prediction.

Features of a text are its distinct words (lower case, outer punctuation cut
off), their first three to five letters, which catch inflected and compound
forms, words' trailing symbols, and the share of distinct words in tenths, all
hashed.  A fit keeps the features that tell the classes apart best
(``KEPT_FEATURES`` by chi-square, counted on its own training rows).

The models are fitted on a bounded sample of labelled rows (``TRAIN_ROWS``,
the first by a hash of the id): only their features reach the driver.  Scoring
covers every whole text and is one Arrow pass without a shuffle; the fitted
weights, a few hundred numbers, travel with the task.

Null text reads as empty: no word, the models' base rate.  Very long texts are read
whole, repeated rows are scored one by one (equal texts get equal scores), and an
empty table of documents gives an empty result and models of no document.  Labels that are
null, or whose document is missing, are left out; several labels of one id
count as the most toxic and the least sound of them.  Without labels, or with
one class only, a category's probability is the constant share of its class.
Other columns are kept as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import free_name, table

#: category and its label from the labels' columns (quality 0/1, toxic 0/1)
CATEGORIES = (
    ("toxic_prose", lambda quality, toxic: (toxic == 1) & (quality == 1)),
    ("toxic_junk", lambda quality, toxic: (toxic == 1) & (quality == 0)),
    ("toxic", lambda quality, toxic: toxic == 1),
)
NAMES = tuple(c for c, _ in CATEGORIES)
TRAIN_ROWS = 8_000
FOLDS = 5
FEATURE_BITS = 20
KEPT_FEATURES = 256
PREFIXES = (3, 4, 5)
MIN_DOCS = 3
L2 = 1e-5
ITERATIONS = 200
#: power of the rarer class's weight: 0 none, 1 balanced
BALANCE = 0.5
#: a decision threshold is searched between these
THRESHOLDS = (0.2, 0.8)
_CACHE_WORDS = 300_000
_EDGE = re.compile(r"^\W+|[\W_]+$")


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1)


def word_features(word: str) -> tuple[int, ...]:
    core = _EDGE.sub("", word)
    out = [_hash("=" + core)] if core else []
    out += [_hash(f"{n}{core[:n]}") for n in PREFIXES if len(core) > n]
    tail = word[len(word.rstrip("#*$%&|<>")):]
    return tuple(out + [_hash("~" + tail[:3])]) if tail else tuple(out)


class _Words(dict):
    """Features of words as they come, of ``chosen`` only if given; bounded."""

    def __init__(self, chosen: dict[int, int] | None = None):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        found = word_features(word)
        if self.chosen is not None:
            found = tuple(self.chosen[f] for f in found if f in self.chosen)
        self[word] = found
        return found


def text_features(text: str, words: _Words) -> set[int]:
    tokens = text.lower().split()
    distinct = set(tokens)
    out: set[int] = set()
    for found in map(words.__getitem__, distinct):
        if found:
            out.update(found)
    if tokens:
        share = _hash(f"share{10 * len(distinct) // len(tokens)}")
        if words.chosen is None:
            out.add(share)
        elif share in words.chosen:
            out.add(words.chosen[share])
    return out


# -- fitting ---------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """A logistic model: chosen hashed features, chain inputs, intercept."""

    def __init__(self, rows: list[np.ndarray], chain: np.ndarray, y: np.ndarray):
        n, positive = len(y), int(y.sum())
        self.threshold = 0.5
        self.features = np.empty(0, np.int64)
        self.weights = np.zeros(chain.shape[1])
        if positive == 0 or positive == n:
            share = positive / n if n else 0.0
            self.bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
            return
        size = 1 << FEATURE_BITS
        inside = np.bincount(np.concatenate([r for r, t in zip(rows, y) if t]), minlength=size)
        every = np.bincount(np.concatenate(rows), minlength=size)
        expected = every * (positive / n)
        chi = np.where(every >= MIN_DOCS, (inside - expected) ** 2 / np.maximum(expected, 1e-9)
                       / np.maximum(1 - every / (n + 1.0), 1e-9), 0.0)
        order = np.argsort(-chi, kind="stable")[:KEPT_FEATURES]
        self.features = order[chi[order] > 10.0].astype(np.int64)
        x = np.hstack([self._dense(rows), chain, np.ones((n, 1))])
        rarer = (n - positive) / positive
        weight = np.where(y, rarer ** BALANCE, 1.0)
        weight = (weight / weight.mean()).astype(np.float32)
        x, target = x.astype(np.float32), y.astype(np.float32)
        w = np.zeros(x.shape[1], np.float32)
        step, speed = np.float32(4.0 / max(1.0, float((x * x).sum(1).mean()))), w.copy()
        for i in range(ITERATIONS):
            gradient = ((_sigmoid(x @ speed) - target) * weight) @ x / n + L2 * speed
            after = speed - step * gradient
            speed = after + np.float32(i / (i + 3.0)) * (after - w)
            w = after
        self.weights, self.bias = w[:-1].astype(float), float(w[-1])

    def _dense(self, rows: list[np.ndarray]) -> np.ndarray:
        place = np.full(1 << FEATURE_BITS, -1)
        place[self.features] = np.arange(len(self.features))
        x = np.zeros((len(rows), len(self.features)))
        for i, r in enumerate(rows):
            at = place[r]
            x[i, at[at >= 0]] = 1.0
        return x

    def probabilities(self, rows: list[np.ndarray], chain: np.ndarray) -> np.ndarray:
        if len(self.weights) == 0 or not len(rows):
            return np.full(len(rows), float(_sigmoid(np.array(self.bias))))
        return _sigmoid(np.hstack([self._dense(rows), chain]) @ self.weights + self.bias)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that separates the classes with the best F1, amid the free space there."""
    if not len(y) or not y.any() or y.all():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    at = int(np.argmax(f1))
    low = p[order[at + 1]] if at + 1 < len(y) else 0.0
    middle = float(_sigmoid((_logit(np.array(p[order[at]])) + _logit(np.array(low))) / 2))
    return min(max(middle, THRESHOLDS[0]), THRESHOLDS[1])


def fit_chain(ids: np.ndarray, rows: list[np.ndarray], labels: np.ndarray) -> list[Linear]:
    """One model a category, its threshold chosen on out-of-fold predictions; ``labels`` has
    a column for each category."""
    fold = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in ids.tolist()], int)
    chain, models = np.zeros((len(rows), 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c]
        seen = np.zeros(len(rows))
        for k in range(FOLDS):
            out = np.flatnonzero(fold == k)
            train = np.flatnonzero(fold != k)
            model = Linear([rows[i] for i in train], chain[train], y[train])
            seen[out] = model.probabilities([rows[i] for i in out], chain[out])
        models.append(Linear(rows, chain, y))
        models[-1].threshold = best_threshold(seen, y)
        chain = np.hstack([chain, _logit(seen)[:, None]])
    return models


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        found = [np.sort(np.fromiter(text_features(t or "", words), "<i4")).tobytes()
                 for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.binary())],
                                         names=["doc_id", "quality", "toxic", "features"])


def train(docs: DataFrame, labels: DataFrame) -> list[Linear]:
    """Fits the chain on at most TRAIN_ROWS labelled documents; of the rows of one id the one
    with the least text, whatever their number."""
    rows = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").cast("long").alias("quality"), F.max("toxic").cast("long").alias("toxic")))
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # TRAIN_ROWS bounds the broadcast side
    joined = (one.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality", "toxic")
              .agg(F.min("text").alias("text")).select("text", "doc_id", "quality", "toxic"))
    got = joined.mapInArrow(_sparse, "doc_id bigint, quality bigint, toxic bigint, features binary").toArrow()
    got = got.take(np.argsort(got.column("doc_id").to_numpy(), kind="stable")) if got.num_rows else got
    quality, toxic = got.column("quality").to_numpy(), got.column("toxic").to_numpy()
    features = [np.frombuffer(f, "<i4") for f in got.column("features").to_pylist()]
    y = np.stack([f(quality, toxic) for _, f in CATEGORIES], 1).astype(float) if len(features) else np.zeros((0, len(NAMES)))
    return fit_chain(got.column("doc_id").to_numpy(), features, y)


# -- scoring ---------------------------------------------------------------------------

def score(docs: DataFrame, models: list[Linear], text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``out``: a struct of a probability for each category."""
    chosen = {int(f): i for i, f in enumerate(np.unique(np.concatenate([m.features for m in models])))}
    tables = []
    for m in models:
        w = np.zeros(len(chosen))
        w[[chosen[int(f)] for f in m.features]] = m.weights[:len(m.features)]
        tables.append((w, m.weights[len(m.features):], m.bias))

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _Words(chosen)
        for batch in batches:
            found = [np.fromiter(text_features(t or "", words), int) for t in batch.to_pylist()]
            chain = np.zeros((len(found), 0))
            out = []
            for w, carry, bias in tables:
                own = np.array([w[f].sum() for f in found]) if len(found) else np.zeros(0)
                p = _sigmoid(own + (chain @ carry if len(carry) else 0.0) + bias)
                out.append(p)
                chain = np.hstack([chain, _logit(p)[:, None]])
            yield pa.StructArray.from_arrays([pa.array(p, pa.float64()) for p in out], names=list(NAMES))

    kind = "struct<" + ",".join(f"{c}:double" for c in NAMES) + ">"
    return docs.withColumn(out, F.arrow_udf(scored, kind)(F.col(text)))


def filter_docs(docs: DataFrame, models: list[Linear]) -> DataFrame:
    """The documents below the threshold for ``toxic``, with their own columns."""
    out = free_name(docs, "toxicity")
    return score(docs, models, out=out).where(~is_toxic(models, out)).select(*docs.columns)


def is_toxic(models: list[Linear], out: str = "toxicity"):
    """True for scored rows at or above the threshold of the category ``toxic``."""
    return F.col(out)["toxic"] >= models[NAMES.index("toxic")].threshold


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    models = train(docs, labels)
    return score(docs.select("doc_id", "text"), models).select(
        "doc_id", *[F.col("toxicity")[c].alias(f"p_{c}") for c in NAMES], is_toxic(models).alias("rejected"))


def run(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
