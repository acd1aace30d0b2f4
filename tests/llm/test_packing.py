"""Packing: every id in exactly one piece, gapless sequences, no padding, ids of the tokenizer."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from custmaster.llm import packing as L

PATH = P.path("word_bpe_49k.json")
T = Tokenizer.from_file(PATH)
T.encode_special_tokens = True


def ids_of(text):
    return np.array(T.encode(text or "", add_special_tokens=False).ids + [L.END_ID], "<u4")


def check(docs):
    rows = L.pack(docs, PATH).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= L.LONGEST and at & (at - 1) == 0 and {r.context for r in pieces} == {at}
    texts = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) * n for (_, t), n in texts.items())
    once = {i for i, n in Counter(i for (i, _), n in texts.items() for _ in range(n)).items() if n == 1}
    for (i, t) in texts:
        if i in once:
            ids, at = ids_of(t), 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    return rows


def test_whole_table(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    tokens = Counter()
    for g, c in {(r.sequence_id, r.step_group): r.context for r in rows}.items():
        tokens[g[1]] += c
    full = sum(n == L.STEP_TOKENS for n in tokens.values())
    assert full >= 0.7 * len(tokens) and max(tokens.values()) <= L.STEP_TOKENS
    assert {512, 1024, 2048, 4096} <= {r.context for r in rows}


def test_odd_rows(odd):
    check(odd)


def test_empty_table(empty):
    assert check(empty) == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" .,'\n\x1c\x85_-²½ªİßΣé1sT日<|endoftext|>"),
                                  st.characters(exclude_categories=["Cs"]))))
def test_word_ids_are_the_tokenizers(text):
    want = np.array(T.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert L.word_ids(PATH).ids(text) == want


@given(st.lists(st.integers(1, 9000), max_size=60))
def test_packer_covers_everything(lengths):
    p = L.Packer()
    for i, n in enumerate(lengths):
        p.add(i, n)
        if i % 7 == 6:
            p.pack()
    p.finish()
    cover = defaultdict(list)
    for doc, start, length, *_ in p.closed:
        cover[doc].append((start, length))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(cover[i]):
            assert start == at
            at += length
        assert at == n


def test_cache_bound_keeps_results():
    small = L.WordIds(PATH, size=3)
    text = "many different words, one after the other, and then the same words again"
    assert small.ids(text) == ids_of(text)[:-1].tobytes() and len(small.known) <= 3 and len(small.parts) <= 3


def test_added_tokens_in_texts():
    untouched = Tokenizer.from_file(PATH)
    for text in ("x <|endoftext|> y", "a<|startoftext|>b", "<|ENDOFTEXT|> é", "<|endoftext", "plain words, only."):
        want = untouched.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(L.word_ids(PATH).ids(text), "<u4").tolist() == want
