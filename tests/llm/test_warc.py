"""WARC data source: round trip, deduplication, pushed predicates, skipped payloads."""
import gzip
import hashlib
import io
import zlib

from custmaster.llm import warc as W
from custmaster.llm.common import shared_path

ROWS = [(3, "http://a/x y", "p" * 150), (1, "http://b/", "p" * 150), (2, None, "p" * 150), (4, "u", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (8, "u", "é" * 50), (9, "u", "é" * 50), (10, "u", "é" * 49), (11, "u", "é" * 49),
        (None, "n", "q" * 200), (12, "n", "q" * 200), (13, "r", "z" * 120), (13, "r", "z" * 120), (14, "h", "HTTP/1.1\r\n\r\n" * 20)]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def plain(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    copies = {}
    for _, _, h in rows:
        copies[(h or "").encode()] = copies.get((h or "").encode(), 0) + 1
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and copies[b] > 1 and first.get(b) != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=repr)


def digest(df):
    return sorted((tuple(r) for r in W.digest(df).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_cases(spark):
    assert digest(pages_of(spark, ROWS)) == plain(ROWS)


def test_whole_table_with_copies(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    rows += [(10_000 + i, u, rows[0][2]) for i, (_, u, _) in enumerate(rows)]      # a hot payload
    assert digest(pages_of(spark, rows)) == plain(rows)


def test_empty_table(spark):
    assert digest(pages_of(spark, [])) == []


def test_filters_are_pushed_and_payloads_skipped(spark):
    path = shared_path(spark, "warc-test")
    W.write(pages_of(spark, ROWS), path)
    df = W.read(spark, path).where("record_type = 'revisit'")
    assert df.count() == sum(r[3] == "revisit" for r in plain(ROWS))
    assert W.read(spark, path).where("target_uri IN ('u', 'h') AND payload_digest IS NOT NULL").count() == 9
    assert W.read(spark, path, payload=False).where("payload IS NOT NULL").count() == 0
    assert W.read(spark, path).where("target_uri LIKE 'http%'").count() == 2


def test_a_file_outside_the_manifest_is_not_read(spark, tmp_path):
    path = str(tmp_path / "w")
    W.write(pages_of(spark, ROWS[:3]), path)
    with open(f"{path}/part-left-behind.warc.gz", "wb") as f:
        f.write(W.member(W.page_record(99, "u", "response", None, "0", b"x")))
    assert W.read(spark, path).count() == 3


class Counting(io.BytesIO):
    pass


def records(n):
    return [W.page_record(i, f"u{i}", "response" if i % 2 else "revisit", i + 1, "d", b"x" * (5000 * i)) for i in range(1, n)]


def test_reader_takes_plain_and_foreign_archives():
    every = lambda h: True
    plainly = b"".join(records(6))
    foreign = b"".join(gzip.compress(r) for r in records(6))
    own = b"".join(W.member(r) for r in records(6))
    want = None
    for data in (plainly, foreign, own):
        got = [(h["WARC-Record-ID"], W.http_payload(b)) for h, b in W.read_records(io.BytesIO(data), every, True)]
        assert len(got) == 5 and (want is None or got == want)
        want = got
    assert zlib.decompress(W.member(b"abc" * 100), 31) == b"abc" * 100


def test_skipped_members_are_not_inflated(monkeypatch):
    inflated = 0
    real = zlib.decompressobj

    class Spy:
        def __init__(self, *a):
            self.z = real(*a)

        def decompress(self, *a):
            nonlocal inflated
            out = self.z.decompress(*a)
            inflated += len(out)
            return out

        def __getattr__(self, k):
            return getattr(self.z, k)

    monkeypatch.setattr(W.zlib, "decompressobj", Spy)
    data = b"".join(W.member(W.page_record(i, "u", "response", None, "d", b"ab" * 500_000)) for i in range(20))
    got = list(W.read_records(io.BytesIO(data), lambda h: h["WARC-Record-ID"] == "<urn:page:7>", True))
    assert len(got) == 1 and inflated < 1_200_000
