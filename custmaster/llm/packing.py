"""Hierarchical multi-length packing.

Documents are tokenised (their ids and an end id) and cut into pieces that
fill sequences of several context sizes, the tiers.  A document's full windows
of the longest size stand alone; what remains is routed to the smallest tier
that holds it.  Tiers are packed from the longest down: a window opens with
the longest waiting remainder of its tier, its gap is filled with the longest
remainder of any shorter tier that fits, and when none fits, with a cut of the
shortest, whose rest is routed anew.  Every closed window is full, so nothing
is padded; what is left at the end of a task becomes sequences of its binary
parts, which are powers of two and need no padding either.  Windows of one
tier form step groups of equal tokens.

Packing needs no shuffle: each task packs the documents it reads, a bounded
buffer at a time, and a task run again packs the same rows alike.  Null text
reads as empty: one piece with the end id alone.  Very long texts are cut into as many
windows as they fill.  Rows of one id, repeated ones too, are packed as the separate
documents they are; remainders of equal length are taken in the order of the rows.  An empty
table gives no sequence; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (512, 1024, 2048, 4096)
LONGEST = TIERS[-1]
END_ID = 2
STEP_TOKENS = 8 * LONGEST
#: tokens that a task holds back before it packs them, and words of a worker's id cache
BUFFER_TOKENS = 1 << 20
CACHE_WORDS = 500_000

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, context bigint, step_group bigint")

#: white space of Python's split that the tokenizer's pattern may see differently
_ODD = re.compile("[\x1c-\x1f]")
#: words whose normal form is their lower case: letters and signs up to U+024F, which have no
#: decomposition to compose, without the one whose lower case has two characters
_PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints,
    else the next free one from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class _Words(dict):
    """Ids of words as they come; starts anew when it is full."""

    def __init__(self, encoder: WordIds):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        e = self.encoder
        if len(self) >= e.size:
            self.clear()
        if _PLAIN.fullmatch(word):
            low = word.lower()
            if low.isalpha():  # the pattern takes a run of letters whole
                ids = e.part(low)
            elif low[-1] in ".," and low[:-1].isalpha():
                ids = e.part(low[:-1]) + e.part(low[-1])
            else:
                ids = b"".join(map(e.part, e.cut(low)))
        else:
            ids = e.whole(word)
        self[word] = ids
        return ids


class WordIds:
    """Ids of texts by a tokenizer that never merges across white space: each distinct word is
    encoded once while it is in the cache. Plain words are cut by the tokenizer's own pattern
    and go to its merges directly; any other goes through the whole tokenizer. A text that
    holds an added token goes through the tokenizer as its file has it."""

    def __init__(self, path: str, size: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.untouched = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        # the empty string, which every text holds, for one that is looked for in the normal form
        self.added = ["" if t["normalized"] else t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.letters = _byte_letters()
        self.size, self.known, self.parts = size, _Words(self), {}

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= self.size:
                self.parts.clear()
            name = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            found = [t.id for t in self.model.tokenize(name)]
            ids = self.parts[part] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if any(token in text for token in self.added):
            return np.asarray(self.untouched.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.whole(text) if _ODD.search(text) else b"".join(map(self.known.__getitem__, text.split()))


_BY_PATH: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's encoder for a vocabulary file, kept from task to task."""
    if path not in _BY_PATH:
        _BY_PATH[path] = WordIds(path)
    return _BY_PATH[path]


class Packer:
    """Packs the documents of one task. ``closed`` gathers pieces
    (document, start, length, sequence, offset, context, step group)."""

    def __init__(self, first_id: int = 0):
        self.next_sequence = first_id
        self.next_group = first_id
        self.closed: list[tuple] = []
        self.waiting = {t: [] for t in TIERS}  # (length, order, document, start), ascending
        self.order = 0
        self.steps: dict[int, list[int]] = {}  # context: [group, tokens in it]

    def route(self, length: int, doc: int, start: int) -> None:
        tier = next(t for t in TIERS if length <= t)
        self.order += 1
        insort(self.waiting[tier], (length, self.order, doc, start))

    def add(self, doc: int, length: int) -> None:
        full = length - length % LONGEST
        for start in range(0, full, LONGEST):
            self._close([(LONGEST, doc, start)], LONGEST)
        if full < length:
            self.route(length - full, doc, full)

    def _close(self, pieces: list[tuple], context: int) -> None:
        step = self.steps.get(context)
        if step is None or step[1] >= STEP_TOKENS:
            step = self.steps[context] = [self.next_group, 0]
            self.next_group += 1
        step[1] += context
        offset = 0
        for length, doc, start in pieces:
            self.closed.append((doc, start, length, self.next_sequence, offset, context, step[0]))
            offset += length
        self.next_sequence += 1

    def _fitting(self, gap: int, tiers: tuple[int, ...]) -> tuple | None:
        """The longest waiting remainder of these tiers of at most ``gap``."""
        for t in reversed(tiers):
            rows = self.waiting[t]
            at = bisect_right(rows, (gap, float("inf")))
            if at:
                return rows.pop(at - 1)
        return None

    def pack(self) -> None:
        """Closes windows, tier by tier, while there is enough waiting to fill one."""
        for i in range(len(TIERS) - 1, -1, -1):
            tier, reach = TIERS[i], TIERS[:i + 1]
            total = sum(r[0] for t in reach for r in self.waiting[t])
            while self.waiting[tier] and total >= tier:
                length, _, doc, start = self.waiting[tier].pop()
                pieces, gap = [(length, doc, start)], tier - length
                while gap:
                    if row := self._fitting(gap, reach):
                        pieces.append((row[0], row[2], row[3]))
                        gap -= row[0]
                        continue
                    source = next((self.waiting[t] for t in TIERS if self.waiting[t]))
                    length, _, doc, start = source.pop(0)
                    pieces.append((gap, doc, start))
                    self.route(length - gap, doc, start + gap)
                    gap = 0
                total -= tier
                self._close(pieces, tier)

    def finish(self) -> None:
        """What is left, as sequences of its binary parts."""
        self.pack()
        rest = [(r[0], r[2], r[3]) for t in reversed(TIERS) for r in reversed(self.waiting[t])]
        self.waiting = {t: [] for t in TIERS}
        total = sum(r[0] for r in rest)
        rest.reverse()
        while total:
            size = 1 << (total.bit_length() - 1)
            size, pieces, gap = min(size, LONGEST), [], min(size, LONGEST)
            total -= size
            while gap:
                length, doc, start = rest.pop()
                take = min(gap, length)
                pieces.append((take, doc, start))
                gap -= take
                if take < length:
                    rest.append((length - take, doc, start + take))
            self._close(pieces, size)


def _batches_of(pieces: list[tuple], docs: dict[int, tuple]) -> pa.RecordBatch:
    rows = []
    for doc, start, length, sequence, offset, context, group in pieces:
        doc_id, data, n = docs[doc]
        rows.append((doc_id, start, length, zlib.crc32(memoryview(data)[4 * start:4 * (start + length)]),
                     n, sequence, offset, context, group))
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                      names=[x.split()[0] for x in SCHEMA.split(", ")])


def pack_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents (doc_id, text) of one task."""
    encoder, end = word_ids(path), np.asarray([END_ID], "<u4").tobytes()
    packer = Packer(TaskContext.get().partitionId() << 36 if TaskContext.get() else 0)
    docs: dict[int, tuple] = {}
    number = held = 0
    for batch in batches:
        for i in range(batch.num_rows):
            data = encoder.ids(batch.column(1)[i].as_py() or "") + end
            docs[number] = (batch.column(0)[i].as_py(), data, len(data) // 4)
            packer.add(number, len(data) // 4)
            number, held = number + 1, held + len(data) // 4
            if held >= BUFFER_TOKENS:
                packer.pack()
                yield _batches_of(packer.closed, docs)
                packer.closed = []
                alive = {r[2] for rows in packer.waiting.values() for r in rows}
                docs = {k: v for k, v in docs.items() if k in alive}
                held = 0
    packer.finish()
    if packer.closed:
        yield _batches_of(packer.closed, docs)


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece of the documents (doc_id, text) by the vocabulary file ``path``,
    which every worker can open."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: pack_batches(it, path), SCHEMA)
