"""Kneser-Ney model: counts, probabilities and scores against a plain model."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from custmaster.llm import kneser_ney as L


def plain(rows):
    texts = {i: [w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + ["</s>"]
             for i, t in rows}
    train = {i for i in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1}
    c, b = Counter(), Counter()
    for i in train:
        c.update(texts[i])
        b.update(zip(["<s>"] + texts[i][:-1], texts[i]))
    n, v, cont = sum(c.values()), len(c), Counter(w for _, w in b)
    follow, context = defaultdict(lambda: [0, 0, 0]), Counter()
    for (x, _), k in b.items():
        follow[x][min(k, 3) - 1] += 1
        context[x] += k
    d2 = L.discounts([sum(k == m for k in b.values()) for m in (1, 2, 3, 4)])
    d1 = L.discounts([sum(k == m for k in cont.values()) for m in (1, 2, 3, 4)])
    spare = sum(d1[min(k, 3)] for k in cont.values())

    def p1(w):
        return (max(cont[w] - d1[min(cont[w], 3)], 0) + spare / (v + 1)) / len(b) if b else 1.0

    def p(x, w):
        if not context[x]:
            return p1(w)
        k, f = b[x, w], follow[x]
        return (max(k - d2[min(k, 3)], 0) + (d2[1] * f[0] + d2[2] * f[1] + d2[3] * f[2]) * p1(w)) / context[x]

    out = {}
    for i, ws in texts.items():
        out[i] = (i not in train, len(ws), sum(c[w] > 0 for w in ws), n,
                  sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws),
                  sum(math.log10(p(x, w)) for x, w in zip(["<s>"] + ws[:-1], ws)))
    return out, p, c


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, p, c = plain(rows)
    got = {r.doc_id: r for r in L.digest(docs).collect()}
    assert set(got) == set(want)
    for i, w in want.items():
        g = got[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == w[:4]
        assert g.base_score == pytest.approx(w[4], rel=1e-9) and g.score == pytest.approx(w[5], rel=1e-9)
    return got, p, c


def test_whole_table(spark):
    got, p, c = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    for context in ("the", "<s>", "never seen"):
        assert sum(p(context, w) for w in [*c, "<unk>"]) == pytest.approx(1)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(odd):
    # one row per id, so that the plain version can key by it
    check(odd.dropDuplicates(["doc_id"]))


def test_several_blocks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3).persist()
    docs.count()
    check(docs)


def test_nothing_to_train_on(docs_of, empty):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = L.digest(docs_of([(i, "some words") for i in ids])).collect()
    assert len(rows) == len(ids) and all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in rows)
    assert L.digest(empty).count() == 0


def test_discounts_stay_in_range():
    for n in ([0, 0, 0, 0], [5, 0, 0, 0], [1, 100, 1, 100], [1000, 400, 200, 120], [10, 3, 0, 1]):
        d = L.discounts(n)
        assert d[0] == 0 and all(0 < d[k] < k for k in (1, 2, 3))


def test_sorted_arrays(tmp_path):
    keys = np.array([3, 9, 2**63, 2**64 - 1], np.uint64)
    values = np.array([[1, 2, 3, 4], [5, 6, 7, 8]])
    stored = L._store(str(tmp_path), "words/0", keys, values)
    assert isinstance(stored[1].code, np.memmap)
    found = L.find(*stored, np.array([0, 9, 2**63, 2**64 - 1, 10], np.uint64))
    assert found.tolist() == [[0, 2, 3, 4, 0], [0, 6, 7, 8, 0]]
    assert L._unpack_sorted(L._pack_sorted(keys)).tolist() == keys.tolist()
    empty = L._store(str(tmp_path), "words/1", keys[:0], values[:, :0])
    assert L.find(*empty, keys).tolist() == [[0] * 4] * 2


def test_stored_values_come_back(tmp_path):
    """Frequent rows of numbers, rare ones, numbers of any size; hashes with many and few of a head."""
    rng = np.random.default_rng(1)
    for n, width in ((50_000, 5), (3000, 1), (4000, 6), (1, 5)):
        keys = np.unique(np.concatenate([rng.integers(0, 2**64, n, np.uint64), rng.integers(0, 2**20, n, np.uint64)]))
        values = rng.geometric(0.93, (width, len(keys))) - 1
        values[:, ::997] = rng.integers(0, 2**40, values[:, ::997].shape)
        stored = L._store(str(tmp_path), f"m/{width}-{n}", keys, values)
        assert np.array_equal(stored[0], keys)
        assert np.array_equal(L.find(*stored, keys), values)
        wanted = rng.integers(0, 2**64, 1000, np.uint64)
        assert np.array_equal(L.find(*stored, wanted)[:, ~np.isin(wanted, keys)].any(), False)
        # bytes stored: 6 a hash and little more than one an n-gram
        if n == 50_000:
            assert (tmp_path / f"m/{width}-{n}.values").stat().st_size < 3.5 * len(keys)


def test_counts_past_32_bits(tmp_path):
    assert L.unpack_counts(L.pack_counts(np.array([0, 2**32, 7]))).tolist() == [0, 2**32, 7]
    # two blocks with 3 billion of one word each, and a sum that 32 bits would show as 0
    keys = np.array([5, 2**60], np.uint64)
    values = np.zeros((L.WORD_VALUES, 2), np.int64)
    values[0] = 3 * 10**9, 2**31
    values[-1] = values[0]
    rows = pa.table({"shard": pa.array([0, 0], pa.int32()), "block": pa.array([1, 2], pa.int64()),
                     "keys": [L._pack_sorted(keys)] * 2, "values": [L.pack_counts(values.ravel())] * 2,
                     "totals": pa.array([None, None], pa.list_(pa.int64()))})
    back = L._shard(str(tmp_path), 1, 2)(rows)
    for data in back.column("values").to_pylist():
        assert L.unpack_counts(data).reshape(L.WORD_VALUES, -1)[0].tolist() == [6 * 10**9, 2**32]
    assert back.column("totals")[0].as_py()[-7] == 6 * 10**9 + 2**32
    _, stored = L.mapped(str(tmp_path), "model/1/0", L.WORD_VALUES)
    assert stored[np.arange(2)][0].tolist() == [6 * 10**9, 2**32]


def plain_of_order(rows, order):
    """Scores of (id, text) by a plain model; a text is its words and an end, after one begin."""
    texts = {i: ["<s>"] + re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"]
             for i, t in rows}
    train = [ws for i, ws in texts.items() if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    raw = {k: Counter(tuple(ws[j:j + k]) for ws in train for j in range(len(ws) - k + 1)) for k in range(1, order + 1)}
    count = {order: raw[order]}
    for k in range(order - 1, 0, -1):
        count[k] = Counter(g[1:] for g in raw[k + 1])
        count[k].update({g: c for g, c in raw[k].items() if k > 1 and g[0] == "<s>"})
    d = {k: L.discounts([sum(c == m for c in count[k].values()) for m in (1, 2, 3, 4)]) for k in count}
    after = defaultdict(lambda: [0, 0.0])
    for k in count:
        for g, c in count[k].items():
            after[g[:-1]][0] += c
            after[g[:-1]][1] += d[k][min(c, 3)]
    v = len(raw[1]) - 1 if train else 0  # without the begin

    def p(context, w):
        k = len(context) + 1
        total, spare = after.get(context, (0, 0))
        if not total:
            return p(context[1:], w) if context else 1.0
        c = count[k][(*context, w)]
        return (max(c - d[k][min(c, 3)], 0) + spare * (p(context[1:], w) if context else 1 / (v + 1))) / total

    return {i: sum(math.log10(p(tuple(ws[max(0, j - order + 1):j]), ws[j])) for j in range(1, len(ws)))
            for i, ws in texts.items()}, p, raw[1]


@pytest.mark.parametrize("order", [3, 4])
def test_higher_orders(spark, odd, order):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3).persist()
    for table in (docs, odd.dropDuplicates(["doc_id"]).persist()):
        rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
        want, p, words = plain_of_order(rows, order)
        got = {r.doc_id: r for r in L.digest(table, order).collect()}
        assert {i: r.score for i, r in got.items()} == {i: pytest.approx(x, rel=1e-9) for i, x in want.items()}
        for context in (("<s>",), ("of", "the"), ("never seen", "the")):
            assert sum(p(context, w) for w in {*(g[0] for g in words), "<unk>"} - {"<s>"}) == pytest.approx(1)


def test_blocks_without_a_trigram(docs_of):
    rows = L.digest(docs_of([(i, "") for i in range(9)]), 3).collect()
    assert sorted(r.doc_id for r in rows) == list(range(9)) and all(r.n_tokens == 1 for r in rows)


def test_registered_order():
    assert L.ORDER >= 3


def test_packed_hashes_take_little_more_than_their_differences_hold():
    """12,000 hashes of a block whose 1.2 million differ by 2^43.8 on average: 45.2 bits, 5.66 bytes each."""
    rng = np.random.default_rng(2)
    for base in (0, 2**63):
        keys = np.uint64(base) + np.cumsum(rng.exponential(2**64 / 1_200_000, 12_000).astype(np.uint64))
        data = L._pack_sorted(keys)
        assert np.array_equal(L._unpack_sorted(data), keys)
        assert len(data) < 5.85 * len(keys)
    assert L._unpack_sorted(L._pack_sorted(keys[:0])).tolist() == []


def test_model_on_disk_is_small(tmp_path):
    """Counts as of the highest order (95 % one, some of any size) take half a byte with the rare ones, hashes
    their differences; both come back from the files, as do rows of several numbers of any codes' width."""
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**64, 200_000, np.uint64))
    values = rng.geometric(0.95, (1, len(keys)))
    values[0, ::5000] = rng.integers(100, 2**15, values[0, ::5000].shape)
    L._store(str(tmp_path), "m/0", keys, values)
    assert (tmp_path / "m/0.values").stat().st_size < 0.6 * len(keys)
    assert (tmp_path / "m/0.keys").stat().st_size < (64 - np.log2(len(keys)) + 2) / 8 * len(keys)
    found, stored = L.mapped(str(tmp_path), "m/0", 1)
    assert np.array_equal(found, keys) and np.array_equal(stored[np.arange(len(keys))], values)
    kinds = set()
    for p in (0.97, 0.6, 0.2):
        for n in (1, 2, 3, 5, 4097):
            values = rng.geometric(p, (5, n)) - 1
            stored = L._store(str(tmp_path), f"m/{p}-{n}", keys[:n], values)
            kinds.add(stored[1].bits)
            at = rng.permutation(n)
            assert np.array_equal(L.find(*stored, keys[:n][at]), values[:, at])
    assert kinds == {2, 4, 8}
