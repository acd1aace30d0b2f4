"""Bottom-k sketches: edited texts, likenesses and merging against plain versions."""
import hashlib
import re

from pyspark.sql import functions as F

from custmaster.llm import fingerprints as L


def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def followers(rows):
    """[(doc_id, text, next text)]: ascending id, ties by text; rows without id come before the first."""
    placed = sorted((i, t or "") for i, t in rows if i is not None)
    out = [(i, t, placed[(k + 1) % len(placed)][1]) for k, (i, t) in enumerate(placed)]
    return out + [(None, t or "", placed[0][1] if placed else t or "") for i, t in rows if i is None]


def check(docs, worst, mean):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = L.digest(docs).collect()
    want = followers(rows)
    key = lambda i, n, sha: (str(i), n, sha)
    edited = []
    for i, t, nxt in want:
        half = len(t) // 2
        edited.append((i, t, nxt, t[:len(t) - half] + nxt[:half]))
    assert sorted(key(r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(
        key(i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, _, e in edited)
    by = {}
    for i, t, nxt, e in edited:
        by.setdefault(key(i, len(t), hashlib.sha256(e.encode()).hexdigest()), []).append((t, nxt, e))
    errors, prints = [], {}
    for r in got:
        t, nxt, e = by[key(r.doc_id, r.n_chars, r.edited_sha256)][0]
        errors += [abs(r.near_edited - likeness(shingle_set(t), shingle_set(e))),
                   abs(r.near_next - likeness(shingle_set(t), shingle_set(nxt)))]
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert prints.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
    assert max(errors) <= worst and sum(errors) / len(errors) <= mean


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), worst=0.2, mean=0.03)


def test_odd_rows(odd):
    check(odd, worst=1e-9, mean=1e-9)          # all sets are smaller than a sketch: exact


def test_sparse_and_far_ids(docs_of):
    check(docs_of([(-9_000_000_000_000_000_000, "a b c d e f"), (9_000_000_000_000_000_000, "g h i j k"),
                   (0, "a b c d e f g"), (1, "q")] + [(10**15 + 7 * i, f"w{i} " * 9) for i in range(200)]), 1e-9, 1e-9)


def test_clustered_ids_are_dealt_out(spark):
    """Ranges follow the data: no task gets many times what it should."""
    ids = list(range(20_000)) + [10**12] + [10**15 + 2**k for k in range(40)] + [10**9 + i for i in range(3000)]
    df = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    ranged, follows = L._ranges(df)
    sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
    assert sum(sizes) == len(ids) and max(sizes) <= 4 * L.RANGE_DOCS
    got = {r.range: r.next_range for r in follows.collect()}
    order = sorted(got)
    assert [got[r] for r in order] == order[1:] + order[:1]
    low = {r.range: r.low for r in ranged.groupBy("range").agg(F.min("doc_id").alias("low")).collect()}
    assert sorted(low, key=low.get) == order  # ranges are in the order of their ids


def test_single_and_empty(docs_of, empty):
    check(docs_of([(5, "only one document here now")]), 1e-9, 1e-9)
    assert L.digest(empty).count() == 0


def test_parts_merge_into_the_whole(spark):
    text = " ".join(f"w{i % 700}x{i}" for i in range(3000))
    words = text.split()
    parts = [" ".join(words[:1000]), " ".join(words[996:2000]), " ".join(words[1996:])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([text, *parts])], "doc_id long, text string")
    s = {r.doc_id: r.s for r in L.with_word_hashes(df, "text", "h").select("doc_id", L.sketch("h").alias("s")).collect()}
    merged = spark.createDataFrame([(s[1], s[2], s[3])], "a array<bigint>, b array<bigint>, c array<bigint>")
    (r,) = merged.select(L.merge(L.merge(F.col("a"), F.col("b")), F.col("c")).alias("m"),
                         L.distinct_count(F.col("a")).alias("n"), L.from_text(L.to_text(F.col("a"))).alias("t")).collect()
    assert r.m == s[0] and r.t == s[1]
    assert abs(r.n - 996) < 0.3 * 996


def test_containment(spark):
    long = " ".join(f"w{i}" for i in range(2000))
    part = " ".join(f"w{i}" for i in range(500))
    df = L.with_word_hashes(L.with_word_hashes(spark.createDataFrame([(part, long)], "a string, b string"), "a", "x"), "b", "y")
    (r,) = df.select(L.containment(L.sketch("x"), L.sketch("y")).alias("c"), L.containment(L.sketch("y"), L.sketch("x")).alias("d")).collect()
    assert r.c > 0.7 and 0.1 < r.d < 0.4


def test_native_plan(odd):
    plan = L.digest(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
