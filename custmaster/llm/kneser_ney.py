"""Language model of any order, interpolated modified Kneser-Ney, counted in Spark.

Tokens are a text's words (runs of characters other than ASCII white space,
A-Z in lower case) and one end; the first word's context is a begin mark.
Words are known by 64-bit hashes, n-grams by a hash of all words' hashes.

An n-gram of the highest order counts its occurrences in training; a shorter one
the distinct words before it or, as nothing stands before the begin mark, its
occurrences where it starts with that.

Texts are read in blocks of bounded size (``gather``).  A block keeps its
documents as numbers of its own word list in a file of the shared folder.  Then,
from the highest order down to single words:

* Each block sends its distinct n-grams, sorted and packed by hash range (shard),
  with its part of their values: the count; as contexts how much of what follows
  counts one, two, three or more, and the sum of those counts beyond three.  The parts
  of shorter n-grams come from the longer ones that the block owns.
* A shard merges what all blocks sent into the model's sorted arrays (hashes,
  values), which it stores, and searches them for each block's n-grams, the stored
  values mapped into memory; back go the values, and to one block an n-gram the mark that it owns it.
* Each block stores the values beside its documents.

At last each block scores its documents from the values that came back.

So no task holds more of the model than a shard (there are twice as many as
shuffle partitions), or more text than a block, and a frequent n-gram is one entry
a block, not one row an occurrence.
What is sent grows with the corpus' distinct n-grams by block.

Training texts are those whose ``crc32(doc_id as text) mod 5`` is not 1; a null
id counts as the empty text (crc32 0, training).  Null text reads as empty: one
token, the end.  Rows of one id are scored one by one.  With no training text
at all every token has probability 1.  Very long texts are scored whole (one may fill a
block alone); equal texts get equal scores, an empty table an empty result; other columns,
whatever their names, are not read.  ``docs`` must be stable when read again.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import filesystem, materialise, pack, shared_path, unpack

BLOCK_CHARS = 20 << 20
ROW_DOCS = 200
_TOKENS = 1 << 18
HELD_OUT = 1
FOLDS = 5
ORDER = 3  # of the registered query
BEGIN, END = b"\t", b"\n"  # no word has these
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def ngram_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from those of its context and its last word."""
    h = before * _MIX + (word ^ (word >> np.uint64(31)))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit hashes: the byte planes of their differences, each compressed by itself (the
    lower ones are random and would spoil the code of the others), after the planes' sizes."""
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view("u1").reshape(-1, 8).T
    parts = [zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    return b"".join([np.array([len(p) for p in parts], "<u8").tobytes(), *parts])


def _unpack_sorted(data: bytes) -> np.ndarray:
    at, planes = 64, []
    for size in np.frombuffer(data, "<u8", 8).tolist():
        planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at:at + size]), "u1"))
        at += size
    return np.cumsum(np.stack(planes, axis=1).view("<u8").ravel(), dtype=np.uint64)


def _kind(values: np.ndarray) -> np.dtype:
    """The narrowest unsigned type that holds all values."""
    return np.min_scalar_type(max(int(values.max(initial=0)), 0)).newbyteorder("<")


def pack_counts(values: np.ndarray) -> bytes:
    """Counts up to 64 bits: the bytes of one, then its byte planes, compressed."""
    kind = _kind(values)
    planes = np.ascontiguousarray(values.astype(kind).view("u1").reshape(-1, kind.itemsize).T)
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_narrow(data: bytes) -> np.ndarray:
    """Counts in the type that they are stored in: to be widened before any arithmetic."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), "u1").reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel()


def unpack_counts(data: bytes) -> np.ndarray:
    return unpack_narrow(data).astype(np.int64)


def _shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the equal hash ranges of the shards begin in ascending keys (shards + 1 places)."""
    bounds = [(s << 64) // shards for s in range(1, shards)]
    inner = np.searchsorted(keys, np.array(bounds, np.uint64))
    return np.concatenate([[0], inner, [len(keys)]])


# -- blocks --------------------------------------------------------------------------------

class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


@dataclass
class Block:
    """Documents of a block: word hashes by local number (0 begin, 1 end), and per document its
    id, whether it trains, and its words' numbers end to end."""
    hashes: np.ndarray
    ids: list
    trains: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens (an end after each document), the document of each and its place in that."""
        n = self.lengths + 1
        ends = np.cumsum(n)
        tokens = np.ones(int(ends[-1]), np.int32)  # a block has fewer than 2^31 of anything
        inside = np.ones(len(tokens), bool)
        inside[ends - 1] = False
        tokens[inside] = self.tokens
        place = np.arange(len(tokens), dtype=np.int32)
        place -= np.repeat((ends - n).astype(np.int32), n)
        return tokens, np.repeat(np.arange(len(n), dtype=np.int32), n), place

    def keys(self, tokens: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
        """For each token the hash of the ``order`` words that end with it, the begin mark being one
        (of no meaning before place ``order`` - 2, where there are not so many)."""
        keys = words = self.hashes[tokens]
        for _ in range(order - 1):
            before = np.empty_like(keys)
            before[1:] = keys[:-1]
            before[place == 0] = self.hashes[0]
            keys = ngram_key(before, words)
        return keys

    def dump(self) -> bytes:
        out = io.BytesIO()
        missing = np.array([i is None for i in self.ids])
        np.savez(out, hashes=self.hashes, ids=np.array([i or 0 for i in self.ids], np.int64), missing=missing,
                 trains=self.trains, lengths=self.lengths, tokens=np.frombuffer(pack(self.tokens), "u1"))
        return out.getvalue()

    @classmethod
    def load(cls, root: str, key: int) -> Block:
        store, path = filesystem(f"{root}/blocks/{key}")
        with store.open_input_file(path) as f, np.load(io.BytesIO(f.read())) as z:
            ids = [None if m else int(i) for i, m in zip(z["ids"], z["missing"])]
            return cls(z["hashes"], ids, z["trains"], z["lengths"], unpack(z["tokens"].tobytes()).view(np.int32))


def _block(texts: list[tuple]) -> Block:
    number = _Words({BEGIN: 0, END: 1})
    tokens = []
    for _, text in texts:
        own = text.lower().split()
        tokens.append(np.fromiter(map(number.__getitem__, own), np.uint32, len(own)))
    lengths = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate(tokens)
    # the most frequent words get the least numbers, which pack best; begin and end stay
    seen = np.bincount(flat, minlength=len(number))
    seen[:2] = seen.max(initial=0) + 1
    order = np.argsort(-seen, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))[order]
    return Block(hashes, [i for i, _ in texts], np.array([not held_out(i) for i, _ in texts]),
                 lengths, place[flat])


def _write(root: str, name: str, data: bytes) -> None:
    """Writes beside the name and moves: a task run again never shows a reader half a file."""
    store, path = filesystem(f"{root}/{name}")
    store.create_dir(path.rpartition("/")[0], recursive=True)
    fresh = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(fresh, compression=None) as f:
        f.write(data)
    store.move(fresh, path)


#: what blocks send, and what shards send back; ``totals``: sums for the whole model so far, in few rows
SENT = "shard int, block bigint, keys binary, values binary, totals array<bigint>"
BACK = "block bigint, shard int, values binary, owned binary, totals array<bigint>"


def _sent(key: int, shards: int, keys: np.ndarray, values: np.ndarray, totals: list[int] | None) -> pa.Table:
    """Rows of ``SENT`` for ascending keys; one without keys where there are none, so that no block is lost."""
    cuts = _shard_cuts(keys, shards)
    parts = [(s, b, e) for s, (b, e) in enumerate(zip(cuts[:-1], cuts[1:])) if e > b] or [(0, 0, 0)]
    return pa.table({"shard": pa.array([s for s, _, _ in parts], pa.int32()),
                     "block": pa.array([key] * len(parts), pa.int64()),
                     "keys": pa.array([_pack_sorted(keys[b:e]) for _, b, e in parts], pa.binary()),
                     "values": pa.array([pack_counts(values[:, b:e].ravel()) for _, b, e in parts], pa.binary()),
                     "totals": pa.array([totals] + [None] * (len(parts) - 1), pa.list_(pa.int64()))})


def _begins(keys: np.ndarray) -> np.ndarray:
    """Where each distinct key begins in ascending keys."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))


class Ngrams:
    """A block's distinct n-grams of one order, ascending by hash: ``keys``; ``where``, a token that
    one ends with; ``at``, for each token that ends one, which; ``before``, for each token, which
    ends before it (both of no meaning at other tokens)."""

    def __init__(self, block: Block, tokens: np.ndarray, place: np.ndarray, order: int):
        if order == 1:
            by_hash = np.argsort(block.hashes)
            self.keys, self.where = block.hashes[by_hash], None
            rank = np.empty(len(by_hash), np.int32)
            rank[by_hash] = np.arange(len(by_hash))
            self.at, begin = rank[tokens], rank[0]
        else:
            ends = np.flatnonzero(place >= order - 2)
            keys = block.keys(tokens, place, order)[ends]
            by_hash = np.argsort(keys)
            keys = keys[by_hash]
            begins = _begins(keys)
            self.keys, self.where = keys[begins], ends[by_hash[begins]].astype(np.int32)
            self.at, begin = np.zeros(len(tokens), np.int32), 0
            self.at[ends[by_hash]] = np.repeat(np.arange(len(begins), dtype=np.int32), np.diff(begins, append=len(keys)))
        self.before = np.empty_like(self.at)
        self.before[1:] = self.at[:-1]
        self.before[place == 0] = begin


def _gather(batches: Iterator[pa.RecordBatch], root: str, shards: int, order: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() if TaskContext.get() else 0
    texts, size, check, done = [], 0, 0, 0

    def closed() -> pa.Table:
        block = _block(texts)
        key = task << 39 | (done & 0x7F) << 32 | check
        _write(root, f"blocks/{key}", block.dump())
        tokens, doc, place = block.sequence()
        grams = Ngrams(block, tokens, place, order)
        trained = block.trains[doc] & (place >= order - 2)
        counts = np.bincount(grams.at[trained], minlength=len(grams.keys))
        return _sent(key, shards, grams.keys, counts[None], None)

    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        for i in range(batch.num_rows):
            text = column[i].as_py() or b""
            texts.append((ids[i], text))
            size += len(text)
            check = zlib.crc32(text, check)
            if size >= BLOCK_CHARS:
                yield from closed().to_batches()
                texts, size, check, done = [], 0, 0, done + 1
    if texts:
        yield from closed().to_batches()


# -- shards --------------------------------------------------------------------------------

#: per n-gram below the highest order: its count (distinct words before it, or occurrences);
#: as a context what the counts of what follows have beyond 3 in sum, and what follows with a
#: count of 1, 2, 3 or more; a word has its tokens in training besides
VALUES, WORD_VALUES = 5, 6


def _summed(totals: pa.ChunkedArray, length: int) -> np.ndarray:
    return np.sum([t for t in totals.to_pylist() if t is not None] or [[0] * length], axis=0, dtype=np.int64)


def _merge(rows: pa.Table, width: int):
    """(blocks, each block's keys, distinct keys, summed values, and in key order all keys' block
    among these, where each distinct key begins, first values, and each row's place there)."""
    rows = rows.sort_by("block")
    each = [_unpack_sorted(x) for x in rows.column("keys").to_pylist()]
    values = [unpack_counts(x).reshape(width, -1) for x in rows.column("values").to_pylist()]
    keys = np.concatenate(each)
    order = np.argsort(keys, kind="stable")
    keys, flat = keys[order], np.concatenate(values, axis=1)[:, order]
    begins = _begins(keys)
    sums = np.add.reduceat(flat, begins, axis=1) if len(begins) else flat
    source = np.repeat(np.arange(len(each)), [len(k) for k in each])[order]
    return rows.column("block").to_pylist(), each, keys[begins], sums, source, begins, flat[0]


class Values:
    """Stored values (``width`` numbers an n-gram): a code of ``bits`` bits each, the number of one of the
    shard's most frequent rows of numbers; the last stands for one of the others, which are found by place."""

    def __init__(self, bits: int, code: np.ndarray, book: np.ndarray, places: np.ndarray, others: np.ndarray):
        self.bits, self.code, self.book, self.places, self.others = bits, code, book, places, others

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        a_byte, last = 8 // self.bits, (1 << self.bits) - 1
        code = self.code[at // a_byte] >> (at % a_byte * self.bits).astype("u1") & np.uint8(last)
        out = self.book[:, code].astype(np.int64)
        other = np.flatnonzero(code == last)
        if len(other):
            out[:, other] = self.others[:, np.searchsorted(self.places, at[other])]
        return out


def _coded(values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits of a code: 2, 4 or 8, which takes the fewest bytes; code of each column of ``values``,
    the columns of all codes)."""
    width, n = values.shape
    # columns of small numbers, as one number each: only they are worth a code
    small = (values < 1 << 12).all(axis=0)
    key = np.zeros(n, np.uint64)
    for row in values[:5]:
        key = key << np.uint64(12) | np.minimum(row, (1 << 12) - 1).astype(np.uint64)
    for row in values[5:]:  # of words, which have one number more
        small &= row < 1 << 4
        key = key << np.uint64(4) | np.minimum(row, (1 << 4) - 1).astype(np.uint64)
    kinds, first, which, seen = np.unique(key[small], return_index=True, return_inverse=True, return_counts=True)
    top = np.argsort(-seen, kind="stable")[:255]
    other = _place_kind(n).itemsize + width * _kind(values).itemsize
    bits = min((2, 4, 8), key=lambda b: n * b / 8 + (n - seen[top[:(1 << b) - 1]].sum()) * other)
    top = top[:(1 << bits) - 1]
    book, code = np.zeros((width, 1 << bits), np.int64), np.full(n, (1 << bits) - 1, np.uint8)
    book[:, :len(top)] = values[:, np.flatnonzero(small)[first[top]]]
    place = np.full(len(kinds), (1 << bits) - 1, np.uint8)
    place[top] = np.arange(len(top))
    code[small] = place[which]
    return bits, code, book


def _place_kind(n: int) -> np.dtype:
    return np.dtype("<u4" if n < 1 << 32 else "<u8")


def _store(root: str, name: str, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, Values]:
    """Stores sorted hashes, as packed differences, and their values; the values come back as ``mapped``."""
    _write(root, f"{name}.keys", _pack_sorted(keys))
    bits, code, book = _coded(values)
    n, a_byte = len(keys), 8 // bits
    places = np.flatnonzero(code == (1 << bits) - 1)
    others = values[:, places]
    kind = _kind(others)
    codes = np.zeros(-(-n // a_byte), np.uint8)  # codes of a byte from its low bits up
    for i in range(a_byte):
        part = code[i::a_byte]
        codes[:len(part)] |= part << np.uint8(i * bits)
    _write(root, f"{name}.values", b"".join([
        np.array([n, bits, len(places), kind.itemsize], "<u8").tobytes(), book.astype("<u8").tobytes(),
        places.astype(_place_kind(n)).tobytes(), codes.tobytes(), others.astype(kind).tobytes()]))
    return keys, _mapped_values(root, name, len(values))


def _mapped_values(root: str, name: str, width: int) -> Values:
    """Stored values, mapped (read, where the shared folder is not a mounted file system)."""
    store, path = filesystem(f"{root}/{name}.values")
    if store.type_name == "local":
        data = np.memmap(path, "u1", "r")
    else:
        with store.open_input_file(path) as f:
            data = np.frombuffer(f.read(), "u1")
    n, bits, n_other, size = data[:32].view("<u8").tolist()
    at = 32 + (8 * width << bits)
    book = data[32:at].view("<u8").reshape(width, 1 << bits)
    wide = _place_kind(n)
    places = data[at:at + wide.itemsize * n_other].view(wide)
    at += wide.itemsize * n_other
    end = at + -(-n * bits // 8)
    others = data[end:end + size * width * n_other].view(f"<u{size}").reshape(width, n_other)
    return Values(bits, data[at:end], book, places, others)


def mapped(root: str, name: str, width: int) -> tuple[np.ndarray, Values]:
    """A stored part of the model: its hashes, and its values mapped into memory."""
    store, path = filesystem(f"{root}/{name}.keys")
    with store.open_input_file(path) as f:
        return _unpack_sorted(f.read()), _mapped_values(root, name, width)


def find(keys: np.ndarray, values: Values, wanted: np.ndarray) -> np.ndarray:
    """The values of wanted hashes in sorted arrays, 0 where there is none."""
    if not len(keys):
        return np.zeros((len(values.book), len(wanted)), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _shard(root: str, order: int, highest: int):
    width = 1 if order == highest else VALUES if order > 1 else WORD_VALUES
    length = 4 * (highest - 1) + 8  # counts of counts 1 to 4 by order from 2; then those of words

    def merge(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        totals = _summed(rows.column("totals"), length)
        blocks, each, keys, sums, source, begins, first = _merge(rows, width)
        known = sums.any(axis=0)
        stored = _store(root, f"model/{order}/{shard}", keys[known], sums[:, known])
        kinds = [np.count_nonzero(sums[0] == k) for k in (1, 2, 3, 4)]
        values = [find(*stored, wanted) for wanted in each]
        if order > 1:
            totals[4 * (order - 2):4 * (order - 1)] += kinds
            # the first block that counts an n-gram owns it
            counted = np.flatnonzero(first > 0)
            group = np.searchsorted(begins, counted, "right") - 1
            lead = _begins(group)
            owner = np.full(len(keys), -1)
            owner[group[lead]] = source[counted[lead]]
            owned = [np.packbits(owner[np.searchsorted(keys, wanted)] == i).tobytes() for i, wanted in enumerate(each)]
        else:
            totals[-8:] += [np.count_nonzero(sums[-1]), sums[-1].sum(), sums[0].sum(), *kinds,
                            np.count_nonzero(sums[0] >= 3)]
            owned = [None] * len(each)
        return pa.table({"block": pa.array(blocks, pa.int64()), "shard": pa.array([shard] * len(blocks), pa.int32()),
                         "values": pa.array([pack_counts(v.ravel()) for v in values], pa.binary()),
                         "owned": pa.array(owned, pa.binary()),
                         "totals": pa.array([totals.tolist()] + [None] * (len(blocks) - 1), pa.list_(pa.int64()))})

    return merge


def _returned(rows: pa.Table, width: int, n: int) -> np.ndarray:
    """The values of a block's n-grams, of which there are n, from all shards."""
    values = np.concatenate([unpack_counts(x).reshape(width, -1)
                             for x in rows.sort_by("shard").column("values").to_pylist()], axis=1)
    if values.shape[1] != n:
        raise ValueError("a block's n-grams do not match: the input changed between reads")
    return values


def _parts(root: str, shards: int, order: int, highest: int):
    """Keeps the values of a block's n-grams of ``order`` + 1; its part of the values of ``order``."""
    width = 1 if order + 1 == highest else VALUES

    def parts(rows: pa.Table) -> pa.Table:
        key = rows.column("block")[0].as_py()
        rows = rows.sort_by("shard")
        block = Block.load(root, key)
        tokens, doc, place = block.sequence()
        longer, grams = Ngrams(block, tokens, place, order + 1), Ngrams(block, tokens, place, order)
        returned = _returned(rows, width, len(longer.keys))
        _write(root, f"blocks/{key}.{order + 1}", pack_counts(returned.ravel()))
        owned = np.concatenate([
            np.unpackbits(np.frombuffer(x, "u1"), count=len(unpack_counts(v)) // width)
            for x, v in zip(rows.column("owned").to_pylist(), rows.column("values").to_pylist())]).astype(bool)
        own, counts, n = longer.where[owned], returned[0][owned], len(grams.keys)
        context = grams.before[own]
        values = np.zeros((VALUES if order > 1 else WORD_VALUES, n), np.int64)
        values[0] = np.bincount(grams.at[own], minlength=n)
        np.add.at(values[1], context, np.maximum(counts - 3, 0))
        for k in (1, 2, 3):
            kind = counts == k if k < 3 else counts >= 3
            values[1 + k] = np.bincount(context[kind], minlength=n)
        if order > 1:
            starts = block.trains[doc] & (place == order - 2)
            values[0] += np.bincount(grams.at[starts], minlength=n)
        else:
            values[-1] = np.bincount(grams.at[block.trains[doc]], minlength=n)
        totals = _summed(rows.column("totals"), 4 * (highest - 1) + 8).tolist()
        return _sent(key, shards, grams.keys, values, totals)

    return parts


# -- probabilities -------------------------------------------------------------------------

def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, from counts of counts."""
    n1, n2, n3, n4 = n
    out, y = np.array([0.0, 0.5, 0.75, 0.9]), n1 / (n1 + 2 * n2) if n1 and n2 else None
    if y is not None:
        for k, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            if low and high:
                out[k] = min(max(k - (k + 1) * y * high / low, 0.05), k - 0.05)
    return out


@dataclass
class Totals:
    """What the shards have in common: distinct words, tokens, distinct bigrams, discounts by order."""
    v: int
    n: int
    cont: int
    words: list[int]  # words with a continuation count of 1, 2, 3 or more
    discounts: list[np.ndarray]

    @classmethod
    def of(cls, sums: list[int]) -> Totals:
        words = sums[-8:]
        return cls(words[0], words[1], words[2], [words[3], words[4], words[7]],
                   [discounts(words[3:7])] + [discounts(sums[i:i + 4]) for i in range(0, len(sums) - 8, 4)])

    def unigram(self, cont: np.ndarray) -> np.ndarray:
        """Continuation probability, the rest spread over the vocabulary and one unknown word."""
        if not self.cont:
            return np.ones(len(cont))
        d = self.discounts[0]
        spare = sum(d * n for d, n in zip(d[1:], self.words))
        return (np.maximum(cont - d[np.minimum(cont, 3)], 0) + spare / (self.v + 1)) / self.cont

    def ngram(self, order: int, count: np.ndarray, context: np.ndarray, follow: np.ndarray,
              lower: np.ndarray) -> np.ndarray:
        """``context``: sum of counts after the context; ``follow``: its follower counts (3 rows)."""
        d = self.discounts[order - 1]
        spare = d[1] * follow[0] + d[2] * follow[1] + d[3] * follow[2]
        direct = np.maximum(count - d[np.minimum(count, 3)], 0)
        return np.where(context > 0, (direct + spare * lower) / np.maximum(context, 1), lower)


def _scores(root: str, totals: Totals, highest: int):
    def score(rows: pa.Table) -> pa.Table:
        key = rows.column("block")[0].as_py()
        block = Block.load(root, key)
        tokens, doc, place = block.sequence()
        grams = Ngrams(block, tokens, place, 1)
        values = _returned(rows, WORD_VALUES, len(grams.keys))
        tokens_of = values[-1][grams.at]
        base = np.log10((tokens_of + 0.5) / (totals.n + 0.5 * (totals.v + 1)))
        p = totals.unigram(values[0])[grams.at]
        for order in range(2, highest + 1):
            longer = Ngrams(block, tokens, place, order)
            store, path = filesystem(f"{root}/blocks/{key}.{order}")
            with store.open_input_file(path) as f:
                counts = unpack_narrow(f.read()).reshape(1 if order == highest else VALUES, -1)
            for at in range(0, len(place), _TOKENS):  # bounds what is held for each token
                ends = at + np.flatnonzero(place[at:at + _TOKENS] >= order - 2)
                context = values[1:5, grams.before[ends]].astype(np.int64)
                seen = context[0] + context[1] + 2 * context[2] + 3 * context[3]
                count = counts[0, longer.at[ends]].astype(np.int64)
                p[ends] = totals.ngram(order, count, seen, context[1:], p[ends])
            longer.keys = longer.where = None  # not needed any more
            grams, values = longer, counts
        n = len(block.ids)
        return pa.table({
            "doc_id": pa.array(block.ids, pa.int64()), "held_out": pa.array(~block.trains),
            "n_tokens": pa.array(block.lengths + 1, pa.int64()),
            "n_known": pa.array(np.bincount(doc, tokens_of > 0, n).astype(np.int64)),
            "train_tokens": pa.array([totals.n] * n, pa.int64()),
            "base_score": pa.array(np.bincount(doc, base, n)),
            "score": pa.array(np.bincount(doc, np.log10(p), n))})

    return score


SCHEMA = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def _freed(df: DataFrame, what: str) -> DataFrame:
    """``materialise``, and what was shuffled for it goes from the disks once it is written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return materialise(df, what, compression="none")
    finally:
        conf.set(name, before)


def score(docs: DataFrame, order: int = 2) -> DataFrame:
    """Trains a model of n-grams up to ``order`` (at least 2) on the training documents (doc_id,
    text), stores it in the shared folder and scores all documents; ``perplexity`` is
    10 ** (-score / n_tokens)."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    root = shared_path(spark, "kneser-ney")
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda it: _gather(it, root, shards, order), SENT)
    for k in range(order, 0, -1):
        back = _freed(sent.groupBy("shard").applyInArrow(_shard(root, k, order), BACK), f"counts-{k}")
        if k > 1:
            sent = back.groupBy("block").applyInArrow(_parts(root, shards, k - 1, order), SENT)
    sums = back.agg(*[F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)) for i in range(4 * (order - 1) + 8)]).first()
    scored = (back.select("block", "shard", "values").groupBy("block")
              .applyInArrow(_scores(root, Totals.of(list(sums)), order), SCHEMA))
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def digest(docs: DataFrame, order: int = 2) -> DataFrame:
    return score(docs, order)
