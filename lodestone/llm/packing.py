"""Sequence packing by harmonic classes.

A document's tokens are cut into pieces: whole sequences first, then pieces of exactly limit / 2^k tokens while the rest
has at least SMALL tokens, then one rest of under SMALL tokens. A piece of length x belongs to the reciprocal class
floor(limit / x), and a bin of class j always takes j pieces, so every worker fills its bins alone, with no shuffle
and no word from other workers. Halving classes fill their bins without any padding. What a worker has left at its end,
under one bin of each class, is cut to fill sequences exactly, and the last one is cut at powers of two, which need no
padding.

Cases: a null or empty text is one piece that holds the end id alone. Repeated rows are packed as often as they stand.
Pieces of a null id have that id.
Texts of any length are cut, never truncated. An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, tidy

LIMIT = 4096
SMALL = 256  # rests under this many tokens go to the finer classes
CACHED = 400_000  # words whose ids a worker keeps

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"


class WordIds:
    """The library's ids of whole texts, through a memory of the ids of each word.

    The tokenizer encodes each word that its pattern finds alone, so a text's ids are its words' ids in a row. Texts that
    hold a special token's string, or letters whose class or case may differ between libraries, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memory: dict[str, bytes] = {}
        #: Characters that the memory is used for: composed Latin, and punctuation that no library disagrees on. On these,
        #: the classes for letters and digits below are those of any version of Unicode.
        self.plain = re.compile("[\t\n\r\\x20-\x7e\xa1-\xac\xae-\u012f\u0132-\u017e\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
        letter, digit = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017e", "0-9\xb2\xb3\xb9\xbc-\xbe"
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^\s{letter}{digit}]+")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes | None] = [None] * len(texts)
        found: list[tuple[int, list[str]]] = []
        odd = []
        for k, t in enumerate(texts):
            if "<|" in t or not self.plain.fullmatch(t):
                odd.append(k)
            else:
                found.append((k, self.words.findall(t.lower())))
        new = list(set().union(*(w for _, w in found)).difference(self.memory)) if found else []
        if len(self.memory) + len(new) > CACHED:
            self.memory.clear()
            new = list(set().union(*(w for _, w in found)))
        for at in range(0, len(new), 20_000):
            self.memory.update(self._alone(new[at : at + 20_000]))
        get = self.memory.__getitem__
        for k, w in found:
            out[k] = b"".join(map(get, w))
        for k in odd:
            out[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, "<u4").tobytes()
        return out  # type: ignore[return-value]

    def _alone(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words with their ids: encoded in one text, in which each is alone between spaces, and cut apart by the library's own word numbers."""
        found = self.library.encode(" ".join(words), add_special_tokens=False)
        ids, number = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
        first = np.flatnonzero(np.diff(number, prepend=-1))
        if len(first) != len(words):  # not a word of the library's each: one by one
            return ((w, np.array(self.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in words)
        raw, ends = ids.tobytes(), np.append(first[1:], len(ids))
        return ((w, raw[a:b]) for w, a, b in zip(words, (4 * first).tolist(), (4 * ends).tolist(), strict=True))


class Packer:
    """The bins of one worker. A piece: [document, start, ids] and, once its sequence is full, sequence, offset, padded length.

    Memory: under one bin of each class stays open, so at most about 25,000 rests of under SMALL tokens.
    """

    def __init__(self, first_id: int, limit: int = LIMIT) -> None:
        self.limit, self.next = limit, first_id
        self.open: dict[int, list[list]] = defaultdict(list)

    def seal(self, pieces: list[list]) -> list[list]:
        at = 0
        for p in pieces:
            p += [self.next, at]
            at += len(p[2]) // 4
        padded = at if at & (at - 1) == 0 else self.limit
        for p in pieces:
            p.append(padded)
        self.next += 1
        return pieces

    def cut(self, total: int) -> Iterator[tuple[int, int]]:
        at, size = 0, self.limit
        while total - at >= SMALL and size >= SMALL:
            while total - at >= size:
                yield at, at + size
                at += size
            size //= 2
        if total > at:
            yield at, total

    def add(self, doc: tuple[int, int], ids: bytes) -> Iterator[list]:
        for start, end in self.cut(len(ids) // 4):
            kind = self.limit // (end - start)
            held = self.open[kind]
            held.append([doc, start, ids[4 * start : 4 * end]])
            if len(held) == kind:
                yield from self.seal(held)
                self.open[kind] = []

    def finish(self) -> Iterator[list]:
        """Fills sequences exactly with what is left; the last is cut at powers of two."""
        rest = [p for kind in sorted(self.open) for p in self.open[kind]]
        left, group = sum(len(p[2]) // 4 for p in rest), []
        room = self._room(left)
        for doc, start, ids in rest:
            while ids:
                take = min(len(ids) // 4, room)
                group.append([doc, start, ids[: 4 * take]])
                start, ids, room, left = start + take, ids[4 * take :], room - take, left - take
                if not room:
                    yield from self.seal(group)
                    group, room = [], self._room(left)
        self.open.clear()

    def _room(self, left: int) -> int:
        return min(self.limit, 1 << (left.bit_length() - 1)) if left else 0


def harmonic_pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, limit: int = LIMIT) -> DataFrame:
    """One row for each piece. tokenizer: path of the vocabulary file on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        encoder = _encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 33, limit)
        tail = np.array([end_id], "<u4").tobytes()

        def table(pieces: list[list]) -> pa.RecordBatch:
            rows = [(doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, padded) for (doc, total), start, ids, sequence, offset, padded in pieces]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * len(names), names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(first, 256).to_pylist()]
                pieces = []
                for doc, ids in zip(keys[first : first + 256], encoder.encode(texts), strict=True):
                    ids += tail
                    pieces += packer.add((doc, len(ids) // 4), ids)
                yield table(pieces)
        yield table(list(packer.finish()))

    bounded_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), SCHEMA)


_ENCODERS: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]
