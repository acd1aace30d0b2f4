"""Document fingerprints by bottom-k sketches of shingle hashes [DataFrame functions only].

A text's words are the runs of characters other than ASCII white space; its
shingles are the windows of five words (a text of one to four words has one
shingle, all of it; a text without words has none).  The sketch is the k
smallest distinct 48-bit hashes of its shingles, ascending.  Sketches of parts
merge into the sketch of the whole (``merge``), and two sketches estimate
resemblance, containment and the number of distinct shingles.

``with_next`` gives each document the one that follows it by ascending id
without a global sort: documents are dealt into id ranges of about 64, a window
inside each range finds the follower, and only the last document of a range
looks the first of the next range up.  Ranges follow the data: one that holds many
more (clustered ids) is divided further, so that none but the rows of one id
has more than four times as many.  The ranges themselves are ordered by a range
partitioning of their first ids and a window inside each part.

Null text reads as empty; two sketches without any hash resemble each other
fully (1.0), one such and another not at all (0.0).  Very long texts are sketched
whole.  Rows of one id, repeated ones too, follow each other by text.  A row without id
has no place in the order: it comes before the first document.  An empty table gives an
empty result, a single document follows itself; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custmaster.llm.common import materialise, table, text_or_empty, words

K = 128
SHINGLE = 5
_BITS = (1 << 48) - 1
#: documents of an id range, more or less
RANGE_DOCS = 64


def with_word_hashes(df: DataFrame, text: str, out: str) -> DataFrame:
    return df.withColumn(out, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))


def sketch(hashes: str, k: int = K) -> Column:
    """Bottom-k sketch from the column of a text's word hashes, in text order."""
    h, n = F.col(hashes), F.size(hashes)
    rest = [lambda i, j=j: F.get(h, i + j) for j in range(1, SHINGLE)]
    windows = F.transform(F.slice(h, 1, n - (SHINGLE - 1)),
                          lambda x, i: F.xxhash64(x, *[r(i) for r in rest]).bitwiseAND(F.lit(_BITS)))
    short = F.array(F.xxhash64(h).bitwiseAND(F.lit(_BITS)))
    shingles = (F.when(n >= SHINGLE, windows).when(n > 0, short)
                .otherwise(F.array().cast("array<bigint>")))
    return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A & B| / |A | B| of the shingle sets, 0 to 1."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(
        shared.cast("double") / F.greatest(F.size(both), F.lit(1)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimate of the number of distinct shingles, exact below k."""
    far = F.get(a, F.lit(k - 1)).cast("double") + 1
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * (_BITS + 1.0) / far)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A & B| / |A|: how much of a's shingles b has, 0 to 1."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), shared / F.greatest(distinct_count(a, k), F.lit(1.0))))


def to_text(a: Column) -> Column:
    """A sketch as text: its hashes in ascending order, comma-joined."""
    return F.array_join(a.cast("array<string>"), ",")


def from_text(s: Column) -> Column:
    return F.when(s == "", F.array().cast("array<bigint>")).otherwise(F.split(s, ",").cast("array<bigint>"))


def _split(doc_id: Column, low: Column, width: Column) -> Column:
    """The least id of the range that an id is in; ranges of ``width`` ids from ``low`` on."""
    wide = doc_id.cast("decimal(20,0)") - low.cast("decimal(20,0)")
    return (low.cast("decimal(20,0)") + wide - F.pmod(wide, width.cast("decimal(20,0)"))).cast("bigint")


def _ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the column range (the least id that the row's range can have), and a table
    (range, next_range); the last is followed by the first.

    Ranges are of equal width at first; one with many more documents than it should have is
    divided by its own least and greatest id, until none is left."""
    docs = docs.where(F.col("doc_id").isNotNull())
    n, low, high = docs.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    span = high - low + 1 if n else 1
    width = F.lit(str(min(span, -(-span * RANGE_DOCS // n)) if n else 1))
    at = _split(F.col("doc_id"), F.lit(low or 0).cast("bigint"), width)
    ids, ranged = docs.select("doc_id").withColumn("range", at), docs.withColumn("range", at)
    while True:
        found = materialise(ids.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"),
                                                     F.max("doc_id").alias("high")), "ranges")
        # rows of one id are not divided: they follow each other by text
        full = found.where((F.col("n") > 4 * RANGE_DOCS) & (F.col("low") < F.col("high")))
        if full.isEmpty():
            break
        span = F.col("high").cast("decimal(20,0)") - F.col("low") + 1
        full = full.select("range", "low", F.ceil(span * RANGE_DOCS / F.col("n")).cast("decimal(20,0)").alias("width"))

        def divided(df: DataFrame, full: DataFrame = full) -> DataFrame:
            at = F.coalesce(_split(F.col("doc_id"), F.col("low"), F.col("width")), F.col("range"))
            return df.join(full, "range", "left").withColumn("range", at).drop("low", "width")

        ids, ranged = divided(ids), divided(ranged)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = materialise(found.select("range").repartitionByRange(parts, "range")
                         .select("range", F.spark_partition_id().alias("block")), "range-order")
    blocks = ranges.groupBy("block").agg(F.min("range").alias("block_first"))
    order = Window.orderBy("block")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(
        F.lead("block_first").over(order),
        F.min("block_first").over(whole)).alias("after"))
    inside = Window.partitionBy("block").orderBy("range")
    follows = (ranges.join(blocks, "block")
               .select("range", F.coalesce(F.lead("range").over(inside), F.col("after")).alias("next_range")))
    return ranged, follows


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): every document with its follower."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    ranged, follows = _ranges(docs)
    order = Window.partitionBy("range").orderBy("doc_id", "text")
    # both uses of this deal the texts out alike (same columns, same filter): shuffled once
    placed = ranged.withColumn("next_text", F.lead("text").over(order))

    def sketched(df: DataFrame, text: str, out: str) -> DataFrame:
        return (with_word_hashes(df, text, "hashes_").withColumn(out, sketch("hashes_")).drop("hashes_"))

    inner = (sketched(placed, "text", "sketch")
             .withColumn("next_sketch", F.lead("sketch").over(order))
             .where(F.col("next_text").isNotNull()))
    # one row a range survives each task's limit, which is planned before the shuffle
    heads = sketched(ranged.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1)
                     .select(F.col("range").alias("next_range"), F.col("text").alias("next_text")),
                     "next_text", "next_sketch")
    lasts = placed.where(F.col("next_text").isNull()).select("doc_id", "text", "range")
    first = follows.agg(F.min("range").alias("next_range"))
    unplaced = docs.where(F.col("doc_id").isNull()).withColumn("one", F.lit(1)).join(
        first.withColumn("one", F.lit(1)), "one").drop("one")
    edges = sketched(lasts.join(follows, "range").select("doc_id", "text", "next_range")
                     .unionByName(unplaced), "text", "sketch")
    edges = edges.join(heads, "next_range", "left").withColumn(
        "next_text", F.coalesce("next_text", "text")).withColumn(
        "next_sketch", F.coalesce("next_sketch", "sketch"))
    cols = ["doc_id", "text", "sketch", "next_text", "next_sketch"]
    return inner.select(*cols).unionByName(edges.select(*cols))


def digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    df = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars").cast("int") - half)
    df = df.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), kept),
                                          F.substring(F.col("next_text"), F.lit(1), half)))
    df = with_word_hashes(df, "edited", "edited_hashes").withColumn("edited_sketch", sketch("edited_hashes"))
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        to_text(F.col("sketch")).alias("fingerprint"),
        to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("sketch")).alias("n_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_share"))


def run(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
