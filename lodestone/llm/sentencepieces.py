"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid out as one text and indexed by a suffix array; a binary search for every piece of
the vocabulary gives the range of its occurrences, the ranges become edges, the edges are sorted by position and relaxed
from left to right. The vocabulary's merges decide which two pieces may be neighbours, so relaxing keeps one piece for
each prefix (bpe.py). No piece reaches from a letter over a space, so words, with the space before them, are encoded
alone; runs of spaces merge last. Letters outside the vocabulary are written as bytes. Map-only: no shuffle.

Cases: a null or empty text has no pieces. The space mark U+2581 in a text reads as a space, as in the library, and is
decoded as one. A null id is returned as it is. Repeated rows give repeated rows; further columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Merges
from .common import bounded_batches, chunks
from .rindex import suffix_ranks

MARK = "▁"
CACHED = 1_000_000  # words whose ids a worker keeps
NORMAL, BYTE = 1, 6

SCHEMA = "doc_id long, n_bytes long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


def _merge_of(piece: str, score: dict[str, float]) -> tuple[str, str] | None:
    """The last merge that makes a piece out of its letters; None if another encoding wins."""
    parts = list(piece)
    while len(parts) > 2:
        found = [(-score[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in score]
        if not found:
            return None
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class PieceCodec:
    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as format_

        with open(path, "rb") as f:
            model = format_.ModelProto.FromString(f.read())
        names = [p.piece for p in model.pieces]
        self.id = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.written = [p.replace(MARK, " ").encode() if q.type == NORMAL else bytes([int(p[3:5], 16)]) if q.type == BYTE else b"" for p, q in zip(names, model.pieces, strict=True)]
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.letters = {p for p in self.id if len(p) == 1}
        self.memory: dict[str, bytes] = {}
        self.spaces: dict[int, list[int]] = {}
        self._pieces([p for p in self.id if len(p) == 1 or set(p) != {MARK}])
        self.segments = re.compile(f"{MARK}?[^{MARK}]+|{MARK}+(?={MARK}[^{MARK}])|{MARK}+")
        self.alone = np.array([self.id[MARK]], "<u4").tobytes()

    def _pieces(self, own: list[str]) -> None:
        """The vocabulary without runs of spaces, as merges."""
        n = max(self.id.values()) + 1
        left, right, rank = np.arange(n), np.arange(n), np.full(n, -1, np.int64)
        pieces: list[bytes | None] = [None] * n
        order = {p: k for k, p in enumerate(sorted((p for p in own if len(p) > 1), key=lambda p: -self.score[p]))}
        among = {p: self.score[p] for p in own}
        pairs = []
        for p in own:
            k = self.id[p]
            if len(p) > 1:
                for i in range(1, len(p)):
                    if p[:i] in among and p[i:] in among:
                        pairs.append((self.id[p[:i]], self.id[p[i:]], order[p]))
                halves = _merge_of(p, among)
                if halves is None:
                    continue
                left[k], right[k], rank[k] = self.id[halves[0]], self.id[halves[1]], order[p]
            pieces[k] = p.encode()
        self.merges = Merges(pieces, left, right, rank, tuple(np.array(x) for x in zip(*pairs, strict=True)))
        known = [k for k, p in enumerate(pieces) if p]
        self.known = np.array(known)
        self.size = np.array([len(p or b"") for p in pieces])
        self.width = int(self.size.max())
        self.table = np.zeros((len(known), self.width), np.uint8)
        for row, k in enumerate(known):
            self.table[row, : self.size[k]] = np.frombuffer(pieces[k], np.uint8)

    def _occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places of all pieces in the text, by suffix array and binary search: starts and piece numbers."""
        order, _ = suffix_ranks(text, 32)
        windows = np.lib.stride_tricks.sliding_window_view(np.concatenate((text, np.zeros(self.width, np.uint8))), self.width)
        size = self.size[self.known]
        inside = np.arange(self.width) < size[:, None]
        wanted = self.table.view(f"S{self.width}").ravel()

        def bound(past: bool) -> np.ndarray:
            lo, hi = np.zeros(len(size), np.int64), np.full(len(size), len(text))
            while (live := np.flatnonzero(lo < hi)).size:
                mid = (lo[live] + hi[live]) // 2
                seen = np.ascontiguousarray(windows[order[mid]] * inside[live]).view(f"S{self.width}").ravel()
                less = seen <= wanted[live] if past else seen < wanted[live]
                lo[live[less]] = mid[less] + 1
                hi[live[~less]] = mid[~less]
            return lo

        first, last = bound(False), bound(True)
        count = last - first
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return order[at], np.repeat(self.known, count)

    def learn(self, words: list[str]) -> None:
        """Encodes words: no space mark but at their head, no letter outside the vocabulary."""
        encoded = [w.encode() for w in words]
        size = np.array([len(w) for w in encoded], np.int64)
        text = np.frombuffer(b"\0".join(encoded) + b"\0", np.uint8)
        start, token = self._occurrences(text)
        by_place = np.argsort(start, kind="stable")
        start, token = start[by_place], token[by_place]
        first = np.cumsum(size + 1) - size - 1
        end = start + self.size[token]
        level = end - first[np.searchsorted(first, start, "right") - 1]
        last, count, first = self.merges.relax(size, start, end, level, token)
        if (last[first + size] == -1).any():
            raise ValueError("a word has no encoding")
        total = count[first + size]
        out = np.zeros(int(total.sum()), "<u4")
        put, node, live = np.cumsum(total) - 1, first + size, np.arange(len(words))
        while len(live):
            t = last[node[live]]
            out[put[live]] = t
            put[live] -= 1
            node[live] -= self.size[t]
            live = live[node[live] > first[live]]
        data, cut = out.tobytes(), 4 * np.append(0, np.cumsum(total))
        self.memory.update((w, data[a:b]) for w, a, b in zip(words, cut[:-1].tolist(), cut[1:].tolist(), strict=True))

    def _run(self, n: int) -> list[int]:
        """A run of n spaces: all its merges have one score, so the leftmost goes first."""
        if n not in self.spaces:
            done: list[int] = []
            todo, most = n, max(len(p) for p in self.id if set(p) == {MARK})
            parts: list[int] = []
            while todo or len(parts) > 1:
                # merge the leftmost neighbours that make a piece, with only as many spaces read as that needs
                i = next((i for i in range(len(parts) - 1) if MARK * (parts[i] + parts[i + 1]) in self.id), None)
                if i is not None:
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                elif todo:
                    parts.append(1)
                    todo -= 1
                else:
                    break
                while len(parts) > 40 and parts[0] == most:
                    done.append(parts.pop(0))
            self.spaces[n] = [self.id[MARK * p] for p in [*done, *parts]]
        return self.spaces[n]

    def split(self, text: str) -> list[str]:
        """Words, runs of spaces, and runs of letters outside the vocabulary."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        odd = set(marked) - self.letters
        if not odd:
            return self.segments.findall(marked)
        parts = re.split("([" + re.escape("".join(odd)) + "]+)", marked)
        return [w for k, p in enumerate(parts) if p for w in ([p] if k % 2 else self.segments.findall(p))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        lists = [self.split(t) for t in texts]
        new = self._new(lists)
        if len(self.memory) + len(new) > CACHED:
            self.memory.clear()
            new = self._new(lists)
        odd = [w for w in new if w[0] not in self.letters]
        for w in odd:
            self.memory[w] = np.array([self.byte[b] for b in w.encode()], "<u4").tobytes()
        runs = {w for w in new if set(w) == {MARK}}
        for w in runs:
            self.memory[w] = np.array(self._run(len(w)), "<u4").tobytes()
        plain = [w for w in new if w[0] in self.letters and w not in runs]
        if plain:
            self.learn(plain)
        return [self._joined(words, "  " in t or MARK in t or t[:1] == " ") for words, t in zip(lists, texts, strict=True)]

    def _new(self, lists: list[list[str]]) -> list[str]:
        return list(set().union(*lists).difference(self.memory)) if lists else []

    def _joined(self, words: list[str], runs: bool) -> bytes:
        out = list(map(self.memory.__getitem__, words))
        if runs:  # a run takes the next word's own space, if that merged with no letter
            for k, w in enumerate(words[:-1]):
                if w[0] == MARK and len(set(w)) == 1 and words[k + 1][0] == MARK and out[k + 1][:4] == self.alone:
                    out[k] = np.array(self._run(len(w) + 1), "<u4").tobytes()
                    out[k + 1] = out[k + 1][4:]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids, without the space that encoding puts in front."""
        text = b"".join(map(self.written.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def piece_round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces and their checksum for each text, and the checksum of what they decode to; round_trip: that this is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            ids, column = batch.column(0).cast(pa.int64()), batch.column(1)
            for first, end, _, offsets in chunks(column, b"", 3 << 20):
                texts = [t or "" for t in column.slice(first, end - first).to_pylist()]
                got = own.encode(texts)
                back = [own.decode(x) for x in got]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first),
                        pa.array(np.diff(offsets)),
                        pa.array([len(x) // 4 for x in got], pa.int64()),
                        pa.array([zlib.crc32(x) for x in got], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                        pa.array([a == b.replace(MARK, " ") for a, b in zip(back, texts, strict=True)]),
                    ],
                    [x.split()[0] for x in SCHEMA.split(", ")],
                )

    bounded_batches(docs.sparkSession)
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, SCHEMA)


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", out: str = "pieces") -> DataFrame:
    """The frame with a column of piece ids."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<int>")
    def encode(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([np.frombuffer(x, "<u4").astype(np.int32) for x in codec(model).encode([t or "" for t in texts])])

    return docs.withColumn(out, encode(docs[text_col]))


def decode_pieces(docs: DataFrame, model: str, pieces_col: str = "pieces", out: str = "decoded") -> DataFrame:
    """The frame with the text of a column of piece ids; null ids give an empty text."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def decode(ids):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(["" if x is None else codec(model).decode(np.asarray(x, "<u4").tobytes()) for x in ids])

    return docs.withColumn(out, decode(docs[pieces_col]))
