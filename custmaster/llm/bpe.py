"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

A text is cut before every single space that stands between two characters
other than white space, and before a comma or full stop after a letter or
digit.  No match of the tokenizer's pattern reaches across such a cut, so the
pieces, *units*, encode independently of each other, and a unit's ids are the
ids of its pattern matches one after the other.

Encoding: the documents of a task are taken in blocks of bounded text.  A block
turns into its distinct units, exploded with their position in the block's
list, and into one row of unit positions for each document.  The units of all
blocks meet, sorted, in the partition of their hash, where each distinct one
is encoded once; its ids go back, packed, to the blocks that hold it, and each
block's documents are reassembled by position.  A word that every document uses makes
one row a block, not one a document, so no key holds more than a sliver of the
rows.  Decoding looks every id up in the token-byte table, whose size the
vocabulary fixes.

The two branches read the documents twice rather than keep a copy, so
``docs`` must be stable when read again (a table; not a sample or a random
order).  A block's key carries a checksum of its texts: if a re-read ever
differed, the blocks would fail to match and raise, not mix.

Null text reads as empty and has no ids.  Very long texts are encoded whole (one may fill
a block alone).  Rows of one id, repeated ones too, are encoded one by one, equal texts alike;
an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import pack, unpack

#: characters of text after which a block is closed; documents of a packed row; units
#: whose ids are gathered before they are sent back
BLOCK_CHARS = 40 << 20
ROW_DOCS = 100
GATHER = 400_000
_ROWS = 50_000
_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=[^\W_])(?=[.,])")
#: a comma or full stop that no letter or digit precedes, where a plain cut would be wrong
_ODD_STOP = re.compile(r"(?<![^\W_])[.,]")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (one base64 token and rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_ENCODERS: dict[tuple, object] = {}


def _encoder(path: str, pattern: str):
    import tiktoken

    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = tiktoken.Encoding(
            "units", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _ENCODERS[path, pattern]


class _Irregular(Exception):
    pass


class _Units(dict):
    """Numbers units as they come; refuses what a plain split at spaces cuts wrongly."""

    def __missing__(self, unit: str) -> int:
        core = unit[1:] if unit[:1] == " " else unit
        if not core or core != core.strip():
            raise _Irregular
        self[unit] = n = len(self)
        return n

    def exact(self, unit: str) -> int:
        return self.setdefault(unit, len(self))


def units_of(text: str) -> list[str]:
    return _CUT.split(text) if text else []


def positions(text: str, number: _Units) -> np.ndarray:
    """The numbers of a text's units, in order."""
    if not text:
        return np.empty(0, "<u4")
    if "\0" not in text and not _ODD_STOP.search(text):
        plain = text.replace(" ", "\0 ").replace(",", "\0,").replace(".", "\0.").split("\0")
        try:
            return np.fromiter(map(number.__getitem__, plain), "<u4", len(plain))
        except _Irregular:
            pass
    exact = units_of(text)
    return np.fromiter(map(number.exact, exact), "<u4", len(exact))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Units, np.ndarray, list, list]]:
    """(key, distinct units, their places by frequency, doc ids, packed positions) of the
    blocks of a task. The key holds the task, the block's number there and a checksum."""
    task = TaskContext.get().partitionId() if TaskContext.get() else 0
    ids, rows, number, seen, size, check, done = [], [], _Units(), np.zeros(0, np.int64), 0, 0, 0

    def closed() -> tuple:
        place = np.empty(len(seen), "<u4")
        place[np.argsort(-seen, kind="stable")] = np.arange(len(seen))
        return (task << 39 | (done & 0x7F) << 32 | check, number, place, ids, rows)

    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py() or ""
            at = positions(text, number)
            if len(number) > len(seen):
                seen = np.concatenate([seen, np.zeros(max(len(number), 1 << 16), np.int64)])
            np.add.at(seen, at, 1)
            ids.append(batch.column(0)[i].as_py())
            rows.append(pack(at))
            size += len(text)
            check = zlib.crc32(text.encode(), check)
            if size >= BLOCK_CHARS:
                seen = seen[:len(number)]
                yield closed()
                ids, rows, number, seen, size, check, done = [], [], _Units(), np.zeros(0, np.int64), 0, 0, done + 1
    if ids:
        seen = seen[:len(number)]
        yield closed()


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, number, place, _, _ in _blocks(batches):
        names = list(number)
        for at in range(0, len(names), _ROWS):
            part = names[at:at + _ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(part), pa.int64()), pa.array(place[at:at + _ROWS].astype(np.int32)),
                 pa.array(part, pa.string())], names=["block", "position", "unit"])


def _doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, _, place, ids, rows in _blocks(batches):
        for at in range(0, len(ids), ROW_DOCS):
            each = [place[unpack(r)] for r in rows[at:at + ROW_DOCS]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([ids[at:at + ROW_DOCS]], pa.list_(pa.int64())),
                 pa.array([pack(np.array([len(x) for x in each]))], pa.binary()),
                 pa.array([pack(np.concatenate(each))], pa.binary())],
                names=["block", "doc_ids", "counts", "positions"])


def _encode_units(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Ids of sorted units: each distinct one is encoded once; packed by block."""
    encode = _encoder(path, pattern).encode_ordinary
    last, ids = None, np.zeros(0, "<u4")
    blocks, places, coded = [], [], []

    def packed() -> pa.RecordBatch:
        block, place = np.concatenate(blocks), np.concatenate(places)
        order = np.argsort(block, kind="stable")
        keys, begins = np.unique(block[order], return_index=True)
        ends = np.append(begins[1:], len(order))
        cols = [[], [], []]
        for b, e in zip(begins, ends):
            own = [coded[i] for i in order[b:e]]
            cols[0].append(pack(place[order[b:e]]))
            cols[1].append(pack(np.array([len(x) for x in own])))
            cols[2].append(pack(np.concatenate(own)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(c, pa.binary()) for c in cols)],
                                          names=["block", "places", "counts", "ids"])

    for batch in batches:
        blocks.append(batch.column(0).to_numpy())
        places.append(batch.column(1).to_numpy())
        for unit in batch.column(2).to_pylist():
            if unit != last:
                last, ids = unit, np.array(encode(unit), "<u4")
            coded.append(ids)
        if len(coded) >= GATHER:
            yield packed()
            blocks, places, coded = [], [], []
    if coded:
        yield packed()


def _reassembler(path: str, decoded: bool):
    def reassemble(units: pa.Table, docs: pa.Table) -> pa.Table:
        """Ids of a block's documents from its units' ids."""
        parts = [[unpack(x) for x in units.column(c).to_pylist()] for c in ("places", "counts", "ids")]
        place, counts, flat = (np.concatenate(p) if p else np.zeros(0, "<u4") for p in parts)
        counts = counts.astype(np.int64)
        begin, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        begin[place], count[place] = np.cumsum(counts) - counts, counts
        doc_ids, ids = [], []
        for row in docs.select(["doc_ids", "counts", "positions"]).to_pylist():
            at = unpack(row["positions"])
            if len(at) and at.max() >= len(count):
                raise ValueError("a block's units do not match its documents: the input changed between reads")
            doc_ids += row["doc_ids"]
            for own in np.split(at, np.cumsum(unpack(row["counts"]))[:-1]):
                n = count[own]
                ends = np.cumsum(n)
                total = int(ends[-1]) if len(ends) else 0
                ids.append(flat[np.repeat(begin[own] - (ends - n), n) + np.arange(total)].tobytes())
        out = {"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(ids, pa.binary())}
        if decoded:
            out["decoded"] = pa.array([decode_ids(x, path) for x in ids], pa.binary())
        return pa.table(out)

    return reassemble


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of documents (doc_id, text): ids little-endian unsigned 32-bit, without
    special tokens; ``decoded`` adds their bytes, looked up anew from the ids. ``path``: the
    ranks, a file that every worker can open."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = docs.mapInArrow(_unit_rows, "block bigint, position int, unit string")
    encoded = (units.repartition(parts, "unit").sortWithinPartitions("unit")
               .mapInArrow(lambda it: _encode_units(it, path, pattern),
                           "block bigint, places binary, counts binary, ids binary"))
    rows = docs.mapInArrow(_doc_rows, "block bigint, doc_ids array<bigint>, counts binary, positions binary")
    return (encoded.groupBy("block").cogroup(rows.groupBy("block"))
            .applyInArrow(_reassembler(path, decoded),
                          "doc_id bigint, ids binary" + ", decoded binary" * decoded))


_TOKENS: dict[str, list[bytes]] = {}


def _tokens(path: str) -> list[bytes]:
    if path not in _TOKENS:
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _TOKENS[path] = table
    return _TOKENS[path]


def decode_ids(ids: bytes, path: str) -> bytes:
    """The bytes of a text's ids, each looked up in the token-byte table."""
    return b"".join(map(_tokens(path).__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(ids: Column, path: str) -> Column:
    """The bytes of a column of ids (as ``encode`` gives them)."""
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if x is None else decode_ids(x, path) for x in batch.to_pylist()], pa.binary())

    return F.arrow_udf(decoded, "binary")(ids)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    coded = encode(docs, path, pattern, decoded=True)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
