"""The registered queries: one per operator and the pipeline; SQL parity where SQL can say it."""
import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"


def test_names():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


@pytest.mark.parametrize("key", ["op4_ngram_jaccard", "op5_quality_rules", "op6_warc", "op11_hard_negatives",
                                 "op12_centroids", "op13_lattice_dedup"])
def test_sql_parity(spark, key):
    r = compare(spark, duck(SF), SF, key, entry.queries()[key], entry.oracle_sql()[key])
    assert r["values_match"], r


def test_clashing_names(spark, odd):
    from custmaster.llm import licenses
    clash = odd.withColumnsRenamed({"n_chars": "license_scan", "source": "license_norm", "lang": "hashes_"})
    assert licenses.scan(clash).columns == [c for c in clash.columns if c != "license_scan"] + ["license_scan"]
    assert licenses.scan(clash).count() == odd.count()
