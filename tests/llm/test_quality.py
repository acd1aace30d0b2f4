"""Rule ledger: measurements against a plain version, policies, ablation."""
import re
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custmaster.llm import quality as Q


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered), max(Counter(w).values(), default=0),
            len([x for x in lines if re.search(r"[.!?:;…。！？][\"')\]]*[\x20\x09-\x0D]*$", x)]))


@given(st.text(alphabet=st.sampled_from("ab \n\té#%| \x1c")))
def test_measure(text):
    assert Q.measure(text.encode()) == plain(text)


def test_many_distinct_words_do_not_overflow(monkeypatch):
    words = [b"w%d" % (i % 900) for i in range(3000)]
    want = Q.repeat_words(words)
    real = len
    monkeypatch.setattr(Q, "len", lambda x: real(x) + (1 << 21 if isinstance(x, dict) else 0), raising=False)
    assert Q.repeat_words(words) == want == 3000


def test_odd_rows(odd):
    got = Q.digest(odd).collect()
    assert len(got) == odd.count()
    want = Counter((r.doc_id, *plain(r.text)[:3]) for r in odd.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols) for r in got) == want
    assert all(r.base_failed and not r.kept for r in got)          # all are short


def test_empty_table(empty):
    assert Q.digest(empty).count() == 0
    assert {r.rejected for r in Q.ablation(Q.ledger(empty)).collect()} <= {0}


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = Q.digest(docs).join(labels, "doc_id")
    assert rows.where("quality = 0 AND kept").count() == 0
    clean = rows.where("quality = 1 AND NOT base_failed")
    assert clean.where("NOT kept").count() <= 0.005 * clean.count()


def test_ablation_is_what_dropping_a_rule_does(spark):
    rows = Q.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).select("doc_id", "rule_bits")
    kept = rows.where(Q.passes()).count()
    for r in Q.ablation(rows).collect():
        without = Q.mask(Q.CURRENT) & ~Q.BIT[r.rule]
        assert rows.where(F.col("rule_bits").bitwiseAND(F.lit(without)) == 0).count() == kept + r.rejected_alone
        assert rows.where(F.col("rule_bits").bitwiseAND(F.lit(Q.BIT[r.rule])) != 0).count() == r.rejected


def test_policies_read_the_stored_ledger(spark, monkeypatch, docs_of):
    """Measured once; a long text is measured whole; several failures are nobody's alone."""
    long = "word and another one. " * 100_000
    docs = docs_of([(1, long), (2, "short"), (3, "% " * 60), (4, " ".join(f"w{i}" for i in range(60)))])
    rows = {r.doc_id: r for r in Q.digest(docs).collect()}
    assert rows[1].n_words == 400_000 and rows[1].alone_rule == "repeated_words" and rows[1].alone_documents == 1
    assert rows[2].alone_rule == "too_short" and rows[3].alone_rule is None and rows[3].alone_documents is None
    assert rows[4].kept and rows[4].kept_v1 and rows[4].kept_v3 and rows[4].rule_bits == 0
    table = Q.stored(docs)
    plan = table.where(Q.passes("v1")).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "rule_bits" in plan
