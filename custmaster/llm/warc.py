"""WARC archives as a PySpark Python data source (format ``warc``).

Writing: each task writes archives of gzip members, one record a member, and
rolls over at a size; only the files in the commit's manifest count, so that
what a lost or repeated task leaves behind is never read.  Every member's gzip
header carries the ``sl`` field of the WARC standard (its compressed and plain
lengths), by which a reader steps from record to record without inflating.

Reading: the files are planned as partitions.  Predicates on the record type
and other header columns are pushed down (``spark.sql.python.filterPushdown.enabled``);
a record's headers are inflated and parsed first, and only if they pass, and
the payload is asked for (option ``payload``, default true), is the rest.
Members without the ``sl`` field, from other writers, are inflated to find
their end; plain (uncompressed) archives are read by content length.

Deduplication (``record_types``): of pages with equal payloads of at least 100
bytes the one with the smallest id is the response and the others revisit it.
The smallest id of a payload is a map-side combined aggregate over digests, and
the join back is salted, so that one payload shared by a third of the pages is
spread over tasks.

Null html reads as an empty payload; a page without id never is the smallest
unless all its copies lack one; repeated rows of the smallest id are all
responses; null urls give no target header.  Payloads are as long as a Spark cell can
be (2 GB), which the ``sl`` field's 32 bits hold.  An empty table gives archives without
records, which read as empty; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, WriterCommitMessage)

from custmaster.llm.common import filesystem, shared_path, table

MIN_SHARED = 100
SALTS = 8
ROLL_BYTES = 64 << 20
MANIFEST = "_files.json"
_SL = b"sl"
_END = b"\r\n\r\n"

#: columns that headers alone decide
HEADER_COLUMNS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
                  "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
READ_SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, "
               "refers_to string, headers map<string,string>, payload binary")
WRITE_COLUMNS = ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload")


# -- records ---------------------------------------------------------------------------

def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with the lengths field ``sl`` (compressed and plain, 32 bits each)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, _SL, 8, size, len(data) & 0xFFFFFFFF)
            + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in headers.items()] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def page_record(page_id: int | None, url: str | None, kind: str, refers_to: int | None,
                digest: str, payload: bytes) -> bytes:
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + _END)
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
               "WARC-Date": "1970-01-01T00:00:00Z"}
    if url is not None:
        headers["WARC-Target-URI"] = " ".join(url.split())
    headers |= {"WARC-Payload-Digest": f"sha256:{digest}", "Payload-Length": str(len(payload))}
    if kind == "revisit":
        headers |= {"WARC-Refers-To": f"<urn:page:{refers_to}>",
                    "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    headers["Content-Type"] = "application/http; msgtype=response"
    return record(headers, head + (payload if kind == "response" else b""))


def parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _lengths(head: bytes) -> int | None:
    """A member's compressed size from its ``sl`` field, if it has one."""
    if not head[3] & 4:
        return None
    end, at = 12 + struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(end, len(head)):
        tag, n = struct.unpack_from("<2sH", head, at)
        if tag == _SL and n >= 8:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + n
    return None


def read_records(stream, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, block) of the records of an archive whose headers satisfy ``wanted``;
    blocks of others, and all if not ``payloads``, are never inflated where the member allows it."""
    buffer = b""

    def need(n: int) -> bool:
        nonlocal buffer
        while len(buffer) < n and (more := stream.read(max(n - len(buffer), 1 << 20))):
            buffer += more
        return len(buffer) >= n

    while need(1):
        if buffer[:2] != b"\x1f\x8b":  # plain archive
            while _END not in buffer and need(len(buffer) + 1):
                pass
            at = buffer.find(_END)
            if at < 0:
                return
            headers = parse_headers(buffer[:at])
            n = int(headers.get("Content-Length", 0))
            need(at + 4 + n + 4)
            block = buffer[at + 4:at + 4 + n]
            buffer = buffer[at + 4 + n + 4:]
            if wanted(headers):
                yield headers, block if payloads else None
            continue
        need(64)
        size = _lengths(buffer)
        inflate = zlib.decompressobj(31)
        if size is not None:
            need(size)
            data, buffer = buffer[:size], buffer[size:]
            plain = inflate.decompress(data, 2048)
            while _END not in plain and not inflate.eof:
                plain += inflate.decompress(inflate.unconsumed_tail, 4096)
            rest = inflate.unconsumed_tail
        else:
            plain = b""
            while not inflate.eof:
                if not buffer and not need(1):
                    break
                plain, buffer = plain + inflate.decompress(buffer), b""
            buffer, rest = inflate.unused_data, b""
        at = plain.find(_END)
        if at < 0:
            continue
        headers = parse_headers(plain[:at])
        if not wanted(headers):
            continue
        if not payloads:
            yield headers, None
            continue
        if rest:
            plain += inflate.decompress(rest) + inflate.flush()
        yield headers, plain[at + 4:at + 4 + int(headers.get("Content-Length", 0))]


def http_payload(block: bytes | None) -> bytes | None:
    return None if block is None else block.partition(_END)[2] if block.startswith(b"HTTP/") else block


# -- data source -----------------------------------------------------------------------

@dataclass
class FilePartition(InputPartition):
    path: str


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]):
        """Takes equality, membership and presence of header columns; returns the rest."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in HEADER_COLUMNS and isinstance(f, EqualTo):
                self.tests.append((HEADER_COLUMNS[column], (f.value,)))
            elif column in HEADER_COLUMNS and isinstance(f, In):
                self.tests.append((HEADER_COLUMNS[column], tuple(f.value)))
            elif column in HEADER_COLUMNS and isinstance(f, IsNotNull):
                self.tests.append((HEADER_COLUMNS[column], ()))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        return all(k in headers and (not v or headers[k] in v) for k, v in self.tests)

    def partitions(self) -> list[FilePartition]:
        store, root = filesystem(self.uri)
        manifests = [f.path for f in store.get_file_info(pafs.FileSelector(root))
                     if f.base_name.endswith(MANIFEST)]
        if manifests:
            names = []
            for m in manifests:
                with store.open_input_file(m) as f:
                    names += json.loads(f.read())
        else:
            names = [f.base_name for f in store.get_file_info(pafs.FileSelector(root))
                     if f.base_name.endswith((".warc", ".warc.gz"))]
        return [FilePartition(f"{root}/{n}") for n in sorted(names)]

    def read(self, partition: FilePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files at all
            return
        store, _ = filesystem(self.uri)
        schema = pa.schema([(c, pa.string()) for c in HEADER_COLUMNS]
                           + [("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        with store.open_input_file(partition.path) as stream:
            for headers, block in read_records(stream, self.wanted, self.payloads):
                payload = http_payload(block) if headers.get("WARC-Type") == "response" else None
                rows.append((*(headers.get(h) for h in HEADER_COLUMNS.values()), list(headers.items()), payload))
                size += len(payload or b"") + 500
                if size > 4 << 20:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.uri = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        store, root = filesystem(self.uri)
        store.create_dir(root, recursive=True)
        names, stream, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in WRITE_COLUMNS]
            for row in zip(*columns):
                if stream is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    stream, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                data = member(page_record(*row))
                stream.write(data)
                size += len(data)
                if size >= ROLL_BYTES:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        return WrittenFiles(names)

    def commit(self, messages: list) -> None:
        store, root = filesystem(self.uri)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{uuid.uuid4().hex}{MANIFEST}") as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list) -> None:
        """Nothing to take back: files outside a manifest are never read."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def record_types(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as rows to write: WRITE_COLUMNS."""
    rows = pages.select(F.col("page_id").cast("long"), "url",
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn(
        "salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    firsts = (rows.where(F.length("payload") >= MIN_SHARED).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
              .select("payload_digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    joined = rows.join(firsts.withColumn("shared", F.lit(True)), ["payload_digest", "salt"], "left")
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"), "payload_digest", "payload")


def write(pages: DataFrame, path: str) -> None:
    spark = pages.sparkSession
    spark.dataSource.register(WarcDataSource)
    record_types(pages).write.format("warc").mode("append").option("path", path).save()


def read(spark, path: str, payload: bool = True) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def _urn(col: str):
    return F.nullif(F.regexp_extract(col, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")


def digest(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives in the shared folder and reads them back: responses with
    their payload, which is measured and digested anew, revisits by their headers alone."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path)
    responses = read(spark, path).where(F.col("record_type") == "response").select(
        _urn("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        _urn("record_id").alias("page_id"), F.col("headers")["Payload-Length"].cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type",
        _urn("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)


def run(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "pages"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p WHERE strlen(html) >= 100 GROUP BY html),
j AS (SELECT p.page_id, p.html, f.first_id, f.html IS NOT NULL AND p.page_id IS DISTINCT FROM f.first_id AS again
      FROM p LEFT JOIN f ON p.html = f.html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to FROM j
"""
