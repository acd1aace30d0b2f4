"""Quality rules as a bitmask ledger.

Every rule is evaluated once for every document: ``ledger`` measures the whole
text in one Arrow pass (bytes in, a struct of counts out), and the rules are
column expressions over the measurements whose failures are the bits of
``rule_bits``.  The ledger is written once (``stored``).  A policy is a version name for a
mask of rules; applying one, or comparing several, reads only the stored bits
(``passes``, ``alone``), and ``ablation`` tells for each rule of a policy what it alone
rejects, by bitwise aggregation over the distinct bit patterns.

Words are runs of characters other than ASCII white space.  Null text reads
as empty: it has no words and fails the length rule.  Very long texts are measured
whole.  Repeated rows each get their own ledger row, texts with equal counts the same
bits; an empty table gives an empty ledger, and an ablation without rejections.  Other
columns of the input are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import free_name, materialise

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_top_word", "n_ended_lines")
_MEASURE_TYPE = "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"
_BLANK_OR_TAIL = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
#: a line of prose ends with one of these, or a quote or bracket after one
_ENDS = tuple(bytes([c]) for c in b".!?:;") + tuple(x.encode() for x in "…。！？")
_CLOSERS = b"\"')]"

MIN_WORDS = 50

#: name and condition of a failure, in the order of the bits
RULES: tuple[tuple[str, object], ...] = (
    ("too_short", lambda m: m["n_words"] < MIN_WORDS),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("symbols", lambda m: 4 * m["n_symbols"] > m["n_words"]),
    ("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    ("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 20 * m["n_words"]),
    ("one_word", lambda m: 4 * m["n_top_word"] > m["n_words"]),
    ("unended_lines", lambda m: (m["n_lines"] >= 10) & (10 * m["n_ended_lines"] < m["n_lines"])),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: versioned policies: the rules whose failure rejects a document
POLICIES = {
    "base": ("too_short", "repeated_words"),
    "v1": ("too_short", "repeated_words", "symbols"),
    "v2": ("too_short", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
    "v3": tuple(name for name, _ in RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def repeat_words(tokens: list[bytes]) -> int:
    """Words inside a three-word window that occurs twice or more, all occurrences included."""
    n = len(tokens)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in tokens), np.int64, n)
    if len(number) == n:
        return 0
    if len(number) < 1 << 21:
        key = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:  # too many distinct words to pack three into 63 bits: number the pairs first
        pair = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1].astype(np.int64)
        key = pair * len(number) + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    tokens = text.split()  # bytes split at space, tab .. carriage return
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(tokens), len(text.translate(None, _BLANK_OR_TAIL)),
            len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeat_words(tokens),
            max(Counter(tokens).values(), default=0),
            sum(x.rstrip().rstrip(_CLOSERS).endswith(_ENDS) for x in lines))


def _measure_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = [measure(x or b"") for x in batch.cast(pa.binary()).to_pylist()]
        cols = list(zip(*rows)) if rows else [()] * len(MEASURES)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(MEASURES))


def ledger(docs: DataFrame, text: str = "text", measures: str = "rule_measures",
           bits: str = "rule_bits") -> DataFrame:
    """``docs`` with the columns ``measures`` (struct) and ``bits`` (long, a bit per failed rule)."""
    take = F.arrow_udf(_measure_batches, _MEASURE_TYPE)
    df = docs.withColumn(measures, take(F.col(text).cast("binary")))
    failed = sum((F.when(cond(F.col(measures)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                  for i, (_, cond) in enumerate(RULES)), F.lit(0).cast("long"))
    return df.withColumn(bits, failed)


def passes(policy: str = CURRENT, bits: str = "rule_bits") -> Column:
    """True for ledger rows that fail no rule of the policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy))) == 0


def alone(policy: str = CURRENT, bits: str = "rule_bits") -> Column:
    """The rule of the policy that alone rejects a ledger row, null where none or several do."""
    failed = F.col(bits).bitwiseAND(F.lit(mask(policy)))
    return F.coalesce(*[F.when(failed == BIT[name], F.lit(name)) for name in POLICIES[policy]])


def stored(docs: DataFrame, measures: str = "rule_measures", bits: str = "rule_bits") -> DataFrame:
    """The ledger of ``docs`` as a table of the shared folder: measured once, read by policies."""
    return materialise(ledger(docs, measures=measures, bits=bits), "ledger")


def filter_docs(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass the policy by the stored ledger, with their own columns."""
    measures, bits = free_name(docs, "rule_measures"), free_name(docs, "rule_bits")
    return stored(docs, measures, bits).where(passes(policy, bits)).select(*docs.columns)


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and that fail no other rule of it
    (those come back if the rule is dropped); and any_bits, the rules failed together with it."""
    names = POLICIES[policy]
    patterns = (rows.groupBy(F.col("rule_bits").bitwiseAND(F.lit(mask(policy))).alias("bits"))
                .agg(F.count("*").alias("n")))
    each = patterns.select("bits", "n", F.explode(F.array(
        *[F.struct(F.lit(x).alias("rule"), F.lit(BIT[x]).cast("long").alias("bit")) for x in names])).alias("r"))
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.lit(policy).alias("policy"),
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("rejected_alone"),
        F.coalesce(F.bit_or(F.when(failed, F.col("bits"))), F.lit(0)).alias("any_bits"))


def digest(docs: DataFrame) -> DataFrame:
    """Measures, verdicts of every policy, the rule that alone rejects a document and how many
    documents come back if it is dropped; all but the measuring from the stored ledger."""
    rows = materialise(ledger(docs.select("doc_id", "text")).drop("text"), "ledger")
    m = F.col("rule_measures")
    base_failed = F.col("rule_bits").bitwiseAND(F.lit(mask("base"))) != 0
    back = ablation(rows).select(F.col("rule").alias("alone_rule"), F.col("rejected_alone").alias("alone_documents"))
    # a row a rule
    return rows.withColumn("alone_rule", alone()).join(F.broadcast(back), "alone_rule", "left").select(
        "doc_id", *[m[x].alias(x) for x in
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed.alias("base_failed"), (passes() & ~base_failed).alias("kept"),
        *[m[x].alias(x) for x in ("n_lines", "n_top_word", "n_ended_lines")], F.col("rule_bits").alias("rule_bits"),
        *[passes(p).alias(f"kept_{p}") for p in ("v1", "v3")], "alone_rule", "alone_documents")


#: The digest in SQL, from the rules' wording.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c > 1),
top AS (SELECT rid, max(c) AS n FROM (SELECT rid, count(*) AS c FROM (SELECT rid, unnest(ws) AS word FROM w) GROUP BY rid, word)
        GROUP BY rid),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
             coalesce(top.n, 0)::BIGINT AS n_top_word,
             len([x for x in ls if regexp_matches(x, '[.!?:;…。！？]["'')\]]*[\x20\x09-\x0D]*$')])::BIGINT AS n_ended_lines
      FROM w LEFT JOIN cov USING (rid) LEFT JOIN top USING (rid)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
               + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
               + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
               + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
               + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
               + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
               + CASE WHEN 4 * n_top_word > n_words THEN 64 ELSE 0 END
               + CASE WHEN n_lines >= 10 AND 10 * n_ended_lines < n_lines THEN 128 ELSE 0 END)::BIGINT AS rule_bits FROM m),
names(b, alone_rule) AS (VALUES (1, 'too_short'), (2, 'repeated_words'), (4, 'symbols'), (8, 'repeated_lines'),
                                (16, 'short_words'), (32, 'long_words'))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (rule_bits & 3) <> 0 AS base_failed, (rule_bits & 63) = 0 AS kept, n_lines, n_top_word, n_ended_lines, rule_bits,
       (rule_bits & 7) = 0 AS kept_v1, rule_bits = 0 AS kept_v3, alone_rule,
       CASE WHEN alone_rule IS NOT NULL THEN count(*) OVER (PARTITION BY rule_bits & 63) END AS alone_documents
FROM f LEFT JOIN names ON b = rule_bits & 63
"""
