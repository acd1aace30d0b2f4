"""The corpus pipeline against its stages' plain versions, and its handling of odd input."""
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline as pipe
from custmaster.llm import quality, toxicity
from .test_ngram_join import plain as near_plain
from .test_quality import plain as measure

SF = "/root/testdata/sf0.001"


def test_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    # quality rules
    names = dict(zip(("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"), range(6)))

    def fails(t):
        m = measure(t)
        w, c, s, n, d, r = (m[names[k]] for k in names)
        return w < 50 or 100 * r > 50 * w or 4 * s > w or 2 * d > n or c < 2 * w or c > 20 * w

    kept = {i: t for i, t in rows.items() if not fails(t)}
    one = quality.filter_docs(docs)
    assert {r.doc_id for r in one.collect()} == set(kept)
    # toxicity: the fitted chain, applied here in plain Python
    models = toxicity.train(one, spark.read.parquet(f"{SF}/labels.parquet"))
    def p(t):
        own, chain = toxicity.text_features(t, toxicity._Words()), []
        for m in models:
            z = sum(w for f, w in zip(m.features.tolist(), m.weights) if f in own) + m.bias
            z += sum(w * x for w, x in zip(m.weights[len(m.features):], chain))
            last = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            chain.append(float(toxicity._logit(np.array(last))))
        return last

    kept = {i: t for i, t in kept.items() if p(t) < models[-1].threshold}
    # near copies
    classes = near_plain(sorted(kept.items()))
    kept = {i: t for i, t in kept.items() if classes[i][0] == i}
    # packing
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = defaultdict(list)
    for r in pipe.run(spark, SF).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(kept)
    for i, text in kept.items():
        ids, at = np.array(t.encode(text, add_special_tokens=False).ids + [2], "<u4"), 0
        for r in sorted(got[i], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_stages_keep_columns_and_take_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in pipe.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
        assert pipe.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_stage_list():
    assert [n for n, _ in pipe.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard", "packing"]
