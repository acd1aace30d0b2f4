"""Byte-level BPE against the tiktoken library and its exact round trip."""
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from custmaster.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def expected(text):
    ids = np.array(ENC.encode_ordinary(text or ""), "<u4")
    return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def check(docs):
    got = sorted(map(tuple, bpe.digest(docs, PATH, P.PATTERN).collect()), key=repr)
    want = sorted(((r.doc_id, *expected(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert got == want


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_odd_rows(odd):
    check(odd)


def test_empty_table(empty):
    assert bpe.digest(empty, PATH, P.PATTERN).count() == 0


def test_general_interface(spark, odd):
    coded = bpe.encode(odd, PATH, P.PATTERN)
    back = coded.withColumn("text", bpe.decode(coded["ids"], PATH).cast("string"))
    want = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=repr)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" .,'\n\t \x1c\x00_-%as1sté日"), st.characters(exclude_categories=["Cs"]))))
def test_units_cut_only_where_no_match_crosses(text):
    names = bpe._Units()
    order = bpe.positions(text, names)
    units = list(names)
    assert "".join(units[i] for i in order) == text
    whole = [m.group() for m in regex.finditer(P.PATTERN, text)]
    assert [m.group() for i in order for m in regex.finditer(P.PATTERN, units[i])] == whole


def test_changed_input_raises():
    import pyarrow as pa
    units = pa.table({"block": [1], "places": [bpe.pack(np.array([0]))], "counts": [bpe.pack(np.array([1]))],
                      "ids": [bpe.pack(np.array([5]))]})
    docs = pa.table({"block": [1], "doc_ids": [[7]], "counts": [bpe.pack(np.array([1]))],
                     "positions": [bpe.pack(np.array([3]))]})
    with pytest.raises(ValueError):
        bpe._reassembler(PATH, False)(units, docs)
