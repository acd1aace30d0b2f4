import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the table's other columns and one that clashes
    with names the operators use."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t), "x", 1) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, rule_bits string, toxicity int")
    return make


#: nulls, empty and blank texts, odd white space and control characters, ties, repeated rows
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d"), (6, "a b c d e"), (7, "a b c d e"),
       (8, "x\x1cy \x85 z q 　 w v"), (9, "café 日本語 naïve \U0001f600 don't I'LL we've  1,000.50!!"),
       (10, "line\nline\n\nline \nother"), (None, "no id here at all today"), (11, "tie " * 300), (12, "tie " * 300),
       (13, "%%% ### a|b <c> $5 & *"), (13, "same id, another text"), (14, "w" * 5000), (15, ". , ., ,. a. .b a,b 1.2 ...")]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def vecs_of(spark):
    """Embeddings from (vec_id, embedding, label), with columns that clash with names the operators use."""
    def make(rows):
        return spark.createDataFrame(
            [(i, e, y, 1, "x", 2, 3, 4) for i, e, y in rows],
            "vec_id long, embedding array<float>, label int, cluster int, node string, row int, unit int, Distance int")
    return make


@pytest.fixture(scope="session")
def odd_vecs(vecs_of):
    """64 components: ties, repeated rows and ids, copies, near copies, and everything that is no vector."""
    import numpy as np

    rng = np.random.default_rng(5)
    base = (rng.standard_normal((60, 64)) / 8).astype("float32")
    rows = [(i, base[i % 40].tolist(), i % 3) for i in range(120)]  # equal vectors, equal and other labels
    rows += [(200 + i, (base[0] + rng.standard_normal(64) * 0.01).astype("float32").tolist(), 1) for i in range(30)]
    rows += [(300 + i, (2 * base[1]).tolist(), 1) for i in range(3)]
    nan, inf = float("nan"), float("inf")
    bad = [nan, inf, -inf, None]
    rows += [(400 + i, base[2].tolist()[:-1] + [x], 2) for i, x in enumerate(bad)]
    rows += [(410, None, 1), (411, [], 1), (412, [0.0] * 64, 1), (413, [0.0] * 64, 1), (414, base[3].tolist(), None),
             (415, base[3].tolist()[:10], 0), (416, base[3].tolist()[:10], 0), (417, [1.0], 0), (418, [-0.0] * 64, 1)]
    rows += [rows[0], rows[0], (0, base[50].tolist(), 0), (None, base[0].tolist(), 0), (None, base[51].tolist(), 1), (-7, base[52].tolist(), 4)]
    return vecs_of(rows)


@pytest.fixture(scope="session")
def no_vecs(vecs_of):
    return vecs_of([])


@pytest.fixture(scope="session")
def by_sql():
    """Whether a result holds the rows of a statement over the same embeddings, read by DuckDB."""
    import duckdb

    from oracle_harness import _by_name, canon, duck_rows

    def same(got, vectors, sql):
        con = duckdb.connect()
        con.register("given", vectors.toArrow())
        con.execute("CREATE TABLE embeddings AS SELECT * FROM given")
        cols = got.columns
        ours = _by_name(cols, [tuple(canon(r[c]) for c in cols) for r in got.collect()])
        theirs = _by_name(*duck_rows(con, sql))
        assert ours[0] == theirs[0]
        assert ours[1] - theirs[1] == {} and theirs[1] - ours[1] == {}
        return sum(ours[1].values())
    return same
