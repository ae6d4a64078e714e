"""Removal of word passages that a document of smaller id holds, by fixed-block anchors.

Documents are cut into non-overlapping reference blocks of ANCHOR words. A window of WINDOW words holds a whole reference block
wherever it starts (WINDOW >= 2 * ANCHOR - 1), so of two equal windows in two documents either one meets the other's reference
blocks. First every rolling window of ANCHOR words of all documents probes the index of reference blocks: each block of documents sends
each bucket its distinct rolling hashes once, with marks for those that are reference blocks and those of several documents, and is told which are
hits: held by a reference block, and by two documents or more. Most of a corpus is done with here. Hits are then extended: all windows of WINDOW words that hold
a hit meet under 128 bits of hash of their words, with the smallest id that has them, and runs of windows that meet a smaller id
are the maximal exact repeats whose words go.

The rolling hash (48 bits of it travel) only chooses what is extended, so a false hit costs a little work and changes nothing. Two different
windows are taken for equal only if 128 bits of their words' hashes agree. A passage in a third of all documents is one entry of
each block's payload, so no bucket has more of it than there are blocks.

Cases: a null or blank text has no words. Words are bytes between white space (\\x20, \\x09-\\x0D), unchanged. Rows of one id do not remove
each other's words. A null id counts as 2^63 - 1, the largest, so rows of null id as one document's. Texts of fewer than WINDOW words keep
all. Repeated rows are each judged alike. Texts of any length are judged whole. An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import SENT, answer, bucket_count, id_column, make_blocks, opened, packed, ranked, rejoin, route, send, split, squeeze
from .common import covered, first_of_runs, mix, words_of

WINDOW, ANCHOR = 13, 7
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_48 = np.uint64(16)  # bits of a rolling hash that are not sent
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
REFERENCE, SEVERAL = np.uint64(1), np.uint64(2)


def _rolling(word: np.ndarray, at: np.ndarray | slice, size: int, step: np.uint64) -> np.ndarray:
    """Hashes of `size` words from each place on."""
    n = max(0, len(word) - size + 1)
    out = np.zeros(n, np.uint64)[at]
    for k in range(size):
        out = out * step + word[k : k + n][at]
    return mix(out)


class Words:
    """The words of a block: whose they are, their hashes, and the distinct rolling hashes of anchors."""

    def __init__(self, row: dict) -> None:
        ids, data, self.offsets = opened(row, b"\n")
        self.own, self.data = ranked(ids), data
        start, end = words_of(data)
        n = len(start)
        self.doc = np.searchsorted(self.offsets, start, "right") - 1
        self.first = np.searchsorted(start, self.offsets)  # of each document (n + 1)
        cuts = np.stack((start, end), 1).ravel()
        array = pa.Array.from_buffers(pa.large_binary(), max(0, 2 * n - 1), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        coded = array.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
        h = xxhash.xxh3_128_digest
        table = np.frombuffer(b"".join([h(w) for w in coded.dictionary.to_pylist()]), "<u8").reshape(-1, 2)
        code = coded.indices.to_numpy()
        self.word = table[code, 0], table[code, 1]

    def whole(self, size: int) -> np.ndarray:
        """Mask of the places where `size` words of one document start."""
        last = self.first[1:] - size + 1
        return covered(len(self.doc), *(x[last > self.first[:-1]] for x in (self.first[:-1], last)))


class Probes:
    """Distinct rolling hashes of a block, in order."""

    def __init__(self, w: Words, buckets: int) -> None:
        self.at = np.flatnonzero(w.whole(ANCHOR))
        key = _rolling(w.word[0], slice(None), ANCHOR, _STEP[0])[self.at] >> _48 << _48
        order = np.argsort(key, kind="stable")
        self.at, key = self.at[order], key[order]
        new = first_of_runs(key)
        self.head, self.of = np.flatnonzero(new), np.cumsum(new) - 1
        self.key = key[self.head]
        self.bucket = route(self.key, buckets)

    def marks(self, w: Words) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, np.uint64)
        doc = w.doc[self.at]
        fixed = (self.at - w.first[doc]) % ANCHOR == 0
        who = w.own[doc]
        several = np.minimum.reduceat(who, self.head) != np.maximum.reduceat(who, self.head)
        return np.logical_or.reduceat(fixed, self.head) * REFERENCE | several * SEVERAL

    def hits(self, got: dict, buckets: int) -> np.ndarray:
        """Places whose hash is a hit."""
        hit = np.zeros(len(self.head), bool)
        for k, part in split(self.bucket, buckets):
            if x := got.get(k):
                hit[np.cumsum(x[0][0]).astype(np.int64) + part.start] = True
        return self.at[hit[self.of]]


class Windows:
    """Distinct windows of a block that hold a hit, in order of their hashes, with the smallest and largest id that have them."""

    def __init__(self, w: Words, hits: np.ndarray, buckets: int) -> None:
        n = len(w.doc)
        doc = w.doc[hits]
        begin, end = np.maximum(hits - (WINDOW - ANCHOR), w.first[doc]), np.minimum(hits, w.first[doc + 1] - WINDOW) + 1
        some = end > begin
        self.at = np.flatnonzero(covered(n, begin[some], end[some]))
        a, b = (_rolling(x, self.at, WINDOW, step) for x, step in zip(w.word, _STEP, strict=True))
        order = np.lexsort((b, a))
        self.at, a, b = self.at[order], a[order], b[order]
        new = first_of_runs(a) | first_of_runs(b)
        self.head, self.of = np.flatnonzero(new), np.cumsum(new) - 1
        self.a, self.b = a[self.head], b[self.head]
        who = w.own[w.doc[self.at]]
        self.least, self.most = (f.reduceat(who, self.head) if len(who) else who for f in (np.minimum, np.maximum))
        self.bucket = route(self.a, buckets)

    def lost(self, w: Words, got: dict, buckets: int) -> np.ndarray:
        """Starts of the windows that a smaller id has."""
        owner = np.full(len(self.head), ~np.uint64(0))
        for k, part in split(self.bucket, buckets):
            if x := got.get(k):
                step, ids = x[0]
                owner[np.cumsum(step).astype(np.int64) + part.start] = ids
        return self.at[owner[self.of] < w.own[w.doc[self.at]]]


def _probe(buckets: int):
    def run(row: dict) -> Iterator[tuple[int, bytes]]:
        w = Words(row)
        p = Probes(w, buckets)
        marks = p.marks(w)
        for k, part in split(p.bucket, buckets):
            yield k, squeeze(np.diff(p.key[part] >> _48, prepend=np.uint64(0)), marks[part])

    return run


def _groups(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal keys together, and the starts of their runs in it."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new |= first_of_runs(k[order])
    return order, np.flatnonzero(new)


def _meet(bucket: int, asked) -> Iterator[tuple[int, bytes]]:
    """Tells each block which of its rolling hashes are hits."""
    key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for _, x in asked])
    mark = np.concatenate([x[1] for _, x in asked])
    order, head = _groups([key])
    runs = np.diff(head, append=len(order))
    marks = np.bitwise_or.reduceat(mark[order], head)
    hit = np.empty(len(order), bool)
    hit[order] = np.repeat((marks & REFERENCE > 0) & ((marks & SEVERAL > 0) | (runs > 1)), runs)
    at = 0
    for block, x in asked:
        mine = np.flatnonzero(hit[at : at + len(x[0])])
        at += len(x[0])
        if len(mine):
            yield block, squeeze(np.diff(mine, prepend=0))


def _extend(buckets: int):
    def run(row: dict | None, got: dict) -> pa.Table:
        out = []
        if row is not None:
            w = Words(row)
            x = Windows(w, Probes(w, buckets).hits(got, buckets), buckets)
            out = [(k, row["block"], squeeze(np.diff(x.a[p], prepend=np.uint64(0)), x.b[p], x.least[p], x.most[p] - x.least[p])) for k, p in split(x.bucket, buckets)]
        return pa.Table.from_batches([packed(out, ("bucket", "block"))])

    return run


def _own(bucket: int, asked) -> Iterator[tuple[int, bytes]]:
    """Tells each block the smallest id of those of its windows of which it has a larger one."""
    a = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for _, x in asked])
    b, least, wide = (np.concatenate([x[k] for _, x in asked]) for k in (1, 2, 3))
    order, head = _groups([a, b])
    owner = np.empty(len(order), np.uint64)
    owner[order] = np.repeat(np.minimum.reduceat(least[order], head), np.diff(head, append=len(order)))
    at = 0
    for block, x in asked:
        part = slice(at, at + len(x[0]))
        at = part.stop
        mine = np.flatnonzero(owner[part] < least[part] + wide[part])
        if len(mine):
            yield block, squeeze(np.diff(mine, prepend=0), owner[part][mine])


def _apply(buckets: int, texts: bool):
    def run(row: dict | None, got: dict) -> pa.Table:
        names = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.string()} if texts else {})
        if row is None:
            return pa.schema(list(names.items())).empty_table()
        w = Words(row)
        x = Windows(w, Probes(w, buckets).hits({k: v for k, v in got.items() if k < buckets}, buckets), buckets)
        lost = x.lost(w, {k - buckets: v for k, v in got.items() if k >= buckets}, buckets)
        gone = covered(len(w.doc), lost, lost + WINDOW)
        first, removed, shas, kept = w.first.tolist(), [], [], []
        body = w.data.tobytes()
        for d, (lo, hi) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True)):
            mine = gone[first[d] : first[d + 1]]
            words = body[lo:hi].split()  # bytes: exactly this white space
            removed.append(int(mine.sum()))
            text = b" ".join(compress(words, ~mine) if removed[-1] else words)
            shas.append(hashlib.sha256(text).hexdigest())
            if texts:
                kept.append(text.decode())
        columns = [id_column(row), pa.array(np.diff(w.first)), pa.array(removed, pa.int64()), pa.array(shas, pa.string())]
        return pa.table(columns + ([pa.array(kept, pa.string())] if texts else []), schema=pa.schema(list(names.items())))

    return run


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """How many words each text has and loses, and the checksum of those it keeps, joined by one space; with texts, also these (kept)."""
    blocks = make_blocks(docs, id_col, text_col)
    buckets = bucket_count(blocks)
    spark = docs.sparkSession
    hits = answer(spark, lambda: send(blocks, _probe(buckets)), buckets, _meet)
    owners = answer(spark, lambda: rejoin(blocks, hits, _extend(buckets), SENT), buckets, _own)
    both = hits.unionByName(owners.withColumn("bucket", F.col("bucket") + buckets))
    return rejoin(blocks, both, _apply(buckets, texts), SCHEMA + (", kept string" if texts else ""))
