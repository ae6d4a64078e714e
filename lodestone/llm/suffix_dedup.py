"""Removal of long repeats by run-length indexes of what documents share.

Every window of WINDOW bytes has an anchor, the gram of GRAM bytes of least hash in it, so equal windows have equal anchors
at equal places, and lie within the anchor's context: all bytes that windows with this anchor can cover. Hashes of grams
and contexts only say where texts may meet; what is removed is decided by run-length indexes (rindex.py), as text:

1. Blocks send each anchor's gram once, with the hash of its context and the smallest document that holds it. A gram of one
   document is done with. One that always stands in the same context has an owner, the smallest document; else it is contested.
2. What lies around anchors with owners is joined to segments, whole documents where these are copies. The owner sends its
   segments, once over all blocks, the others claim theirs as text; where they meet, a run-length index is built of the
   owners' segments and the claims are streamed through it: windows whose matching statistic is WINDOW or more are repeats.
3. Contested grams (the borders of repeats) send their distinct contexts as text; these are indexed and streamed alike, and
   the places of the matches tell the first document of each window.

A wrong meeting removes nothing. Only where two different contexts of a gram agree in the 48 bits of hash that are sent is the gram taken to have one context, so that
a repeat around it can be kept.

Hot keys are split. A gram seen at very many places sends its contexts once for each of several ranges of windows, routed by
the bytes that all windows of the range share; within a bucket, what would outgrow an index is split in the same way. A
range of one window has one text, so in the end every block sends it once. An owner claimed by very many blocks is sent to
several buckets, and each block claims in one of them; long owners go piece by piece.

Cases: a null or empty text, or one of fewer than WINDOW bytes, loses nothing. Repeats within one document, and rows with
the same doc_id, do not count against each other. Ids are ordered as signed integers; a null doc_id counts as the
largest, 2^63 - 1. Texts of any bytes and length are compared whole. An empty table gives an empty table; further columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import SENT, answer, bucket_count, carried, id_column, make_blocks, opened, ranked, rejoin, route, send, split, squeeze
from .common import covered, first_of_runs, mix
from .rindex import RunIndex, suffix_ranks

WINDOW, GRAM = 50, 16
STARTS = WINDOW - GRAM + 1  # windows that can have one anchor
SIDE = WINDOW - GRAM
WIDTH = 2 * SIDE + GRAM
INDEXED = 700_000  # bytes of text in one index
HOT_PLACES = 16_384  # places of a gram for each range of windows that its contexts are sent for
HOT_BLOCKS = 2_048  # blocks that claim an owner in one bucket
OWNED = 18  # bits: a long owner goes in pieces of 2^OWNED bytes
STREAMED = 128  # windows of a claim in one row of those streamed together
NOT = 0xFF  # never a byte of UTF-8; stands around texts
NEVER = np.uint64((1 << 64) - 1)
_48 = np.uint64(16)  # bits of a gram's hash that are not sent
PIECE = 1 << 18  # windows whose anchors are found at once
_PLACE = np.uint64(24)  # bits of a hash that give way to a place in a piece
ALONE, OWNER, CLAIM, FOUGHT = 0, 1, 2, 3  # what a gram of a block is


def _ranges() -> list[list[tuple[int, int]]]:
    """Ranges (first, last) of the windows of a context: all, halves, quarters and so on down to single windows."""
    out = [[(0, STARTS - 1)]]
    while any(a < b for a, b in out[-1]):
        out.append([x for a, b in out[-1] for x in ([(a, (a + b) // 2), ((a + b) // 2 + 1, b)] if a < b else [(a, b)])])
    return out


LEVELS = _ranges()
RANGES = [r for level in LEVELS for r in level]
_FIRST_RANGE = np.cumsum([0, *map(len, LEVELS)])

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _lowest(word: np.ndarray, lo: int, hi: int, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of those windows that start in lo..hi-1, in order, with repeats of a place left out."""
    m = hi - lo + STARTS - 1
    gram = word[lo : lo + m] * np.uint64(0x9E3779B97F4A7C15)
    gram ^= gram >> np.uint64(29)
    gram += word[lo + 8 : lo + 8 + m]
    gram = mix(gram)
    low = gram >> _PLACE << _PLACE
    low |= np.arange(m, dtype=np.uint64)  # the first of equals
    span = 1
    while 2 * span <= STARTS:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: hi - lo], low[STARTS - span :])
    at = (low[windows[lo:hi]] & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    at = at[first_of_runs(at)]
    return at + lo, gram[at]


def _levels(count: np.ndarray, most: int, top: int = 62) -> np.ndarray:
    """How often count is to be halved until it is at most `most`."""
    return np.minimum(np.ceil(np.log2(np.maximum(count, 1) / most)).clip(0), top).astype(np.int64)


class Anchors:
    """The anchors of a block by gram, and what is to be said of each gram."""

    def __init__(self, row: dict, buckets: int) -> None:
        pad = bytes([NOT]) * WINDOW
        ids, data, offsets = opened(row, pad)
        self.own, self.number = ranked(ids), row["block"]
        self.data = data = np.concatenate((np.frombuffer(pad, np.uint8), data))
        self.head, self.stop = offsets[:-1] + WINDOW, offsets[1:]  # of the texts in data
        n = len(data)
        self.word = word = np.ndarray((n - 7,), "<u8", data, strides=(1,))
        long = self.stop - self.head >= WINDOW
        windows = covered(n, self.head[long], self.stop[long] - WINDOW + 1)
        found = [_lowest(word, lo, min(lo + PIECE, n - WINDOW + 1), windows) for lo in range(0, n - WINDOW + 1, PIECE)]
        at, key = (np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(zip(*found, strict=True) if found else ((), ()), (np.int64, np.uint64), strict=True))
        new = first_of_runs(at)
        at, key = at[new], mix(key[new]) >> _48 << _48  # anchors have low hashes; mixed, they spread over all buckets
        order = np.argsort(key, kind="stable")
        self.at, key = at[order], key[order]
        self.doc = np.searchsorted(self.head, self.at, "right") - 1
        new = first_of_runs(key)
        self.first, self.of = np.flatnonzero(new), np.cumsum(new) - 1
        self.key = key[self.first]
        self.bucket = route(self.key, buckets)
        who = self.own[self.doc]
        self.least = np.minimum.reduceat(who, self.first) if len(who) else who
        # of each gram, the first place in its smallest document
        held = np.flatnonzero(who == self.least[self.of])
        self.place = held[first_of_runs(self.of[held])]

    def said(self) -> tuple[np.ndarray, ...]:
        """For each gram: hash of its context, whether there are several documents (1) or contexts (2), places, and piece of the smallest document."""
        context = np.zeros(len(self.at), np.uint64)
        for k, shift in enumerate((-34, -26, -18, -10, -8, 0, 8, 16, 24, 32, 40, 42)):
            context = mix(context * np.uint64(0xC2B2AE3D27D4EB4F) + self.word[self.at + shift] + np.uint64(k))
        context >>= _48
        if not len(context):
            return context, context, context, context
        least = np.minimum.reduceat(context, self.first)
        marks = (np.maximum.reduceat(self.own[self.doc], self.first) != self.least) + 2 * (np.maximum.reduceat(context, self.first) != least)
        return least, marks.astype(np.uint64), np.diff(self.first, append=len(context)).astype(np.uint64), (self._offset(self.place) >> OWNED).astype(np.uint64)

    def _offset(self, places: np.ndarray) -> np.ndarray:
        return self.at[places] - self.head[self.doc[places]]


def _grams(buckets: int):
    def run(row):
        a = Anchors(row, buckets)
        said = a.said()
        for k, part in split(a.bucket, buckets):
            # keys ascend: their steps need fewer bytes
            yield k, squeeze(np.diff(a.key[part] >> _48, prepend=np.uint64(0)), a.least[part], *(x[part] for x in said))

    return run


def _settle(bucket: int, asked):
    """Answers each block: which of its grams are shared, what they are to it, and of those with an owner the owner, piece and level, of contested ones the level."""
    key, least, context, marks, places, piece = (np.concatenate([np.cumsum(x[0]) if k == 0 else x[k] for _, x in asked]) for k in range(6))
    order = np.argsort(key, kind="stable")
    k = key[order]
    heads = np.flatnonzero(first_of_runs(k))
    of = np.cumsum(first_of_runs(k)) - 1
    least, context, marks, piece = least[order], context[order], marks[order], piece[order]
    owner = np.minimum.reduceat(least, heads)
    shared = (owner != np.maximum.reduceat(least, heads)) | (np.bitwise_or.reduceat(marks, heads) & np.uint64(1) > 0)
    fought = (np.minimum.reduceat(context, heads) != np.maximum.reduceat(context, heads)) | (np.bitwise_or.reduceat(marks, heads) & np.uint64(2) > 0)
    level = np.where(fought, _levels(np.add.reduceat(places[order], heads), HOT_PLACES, len(LEVELS) - 1), _levels(np.diff(heads, append=len(k)), HOT_BLOCKS))
    holds = np.flatnonzero(least == owner[of])
    one = holds[first_of_runs(of[holds])]  # the one entry that speaks for the owner
    is_ = np.where(shared, np.where(fought, FOUGHT, CLAIM), ALONE)[of]
    is_[one[is_[one] == CLAIM]] = OWNER
    says = np.empty((4, len(order)), np.uint64)
    says[0, order], says[1, order], says[2, order], says[3, order] = is_, np.where(fought, 0, owner)[of], piece[one][of], level[of]
    at = 0
    for block, x in asked:
        mine = says[:, at : at + len(x[0])]
        at += len(x[0])
        some = np.flatnonzero(mine[0])
        if len(some):
            yield block, squeeze(np.diff(some, prepend=0), *mine[:, some])


class Meeting:
    """What a block sends to where texts meet, and what the answers mean for it."""

    def __init__(self, a: Anchors, got: dict, buckets: int) -> None:
        self.a, self.buckets = a, buckets
        n = len(a.first)
        self.is_, self.owner, self.piece, self.level = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k, part in split(a.bucket, buckets):
            if x := got.get(k):
                step, is_, owner, piece, level = x[0]
                at = np.cumsum(step).astype(np.int64) + part.start
                self.is_[at], self.owner[at], self.piece[at], self.level[at] = is_, owner, piece, level

    def _segments(self, places: np.ndarray) -> list[np.ndarray]:
        """Begin, end, owner and group of the stretches covered by the contexts of these places, each of one document and group."""
        a = self.a
        places = places[np.argsort(a.at[places], kind="stable")]
        gram, doc, at = a.of[places], a.doc[places], a.at[places]
        begin, end = np.maximum(at - SIDE, a.head[doc]), np.minimum(at + WINDOW, a.stop[doc])
        owner, level = self.owner[gram], self.level[gram].astype(np.uint64)
        group = mix(mix(owner) + mix(self.piece[gram].astype(np.uint64) << np.uint64(6) | level)) >> np.uint64(6) << np.uint64(6) | level
        new = first_of_runs(doc) | first_of_runs(group) | first_of_runs(owner)
        new[1:] |= begin[1:] > end[:-1]
        last = np.append(np.flatnonzero(new)[1:], len(new))[: int(new.sum())] - 1
        return [begin[new], end[last], owner[new], group[new]]

    def owned(self) -> list[np.ndarray]:
        """The segments of which this block speaks for the owner."""
        return self._segments(self.a.place[self.is_[self.a.of[self.a.place]] == OWNER])

    def claims(self) -> list[np.ndarray]:
        """Segments that a smaller document owns."""
        is_ = self.is_[self.a.of]
        return self._segments(np.flatnonzero(((is_ == CLAIM) | (is_ == OWNER)) & (self.owner[self.a.of] < self.a.own[self.a.doc])))

    def _texts(self, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
        whole = self.a.data.tobytes()
        return [whole[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)]

    def claimed(self) -> tuple[list[np.ndarray], np.ndarray, dict[int, list[tuple]]]:
        """The claims, the number of each in its bucket's list, and these lists of distinct (group, owner, text)."""
        segments = self.claims()
        begin, end, owner, group = segments
        salt = mix(np.full(len(begin), self.a.number, np.uint64)) % (np.uint64(1) << (group & np.uint64(63)))
        bucket = route(mix(group + salt), self.buckets)
        lists: dict[int, dict[tuple, int]] = {}
        number = np.empty(len(begin), np.int64)
        for k, (b, g, o, t) in enumerate(zip(bucket.tolist(), group.tolist(), owner.tolist(), self._texts(begin, end), strict=True)):
            known = lists.setdefault(b, {})
            number[k] = known.setdefault((g, o, t), len(known))
        return [*segments, bucket], number, {b: list(known) for b, known in lists.items()}

    def offered(self) -> dict[int, list[tuple]]:
        """By bucket, the distinct (group, owner, text) of owners: of a hot owner one for each salt."""
        begin, end, owner, group = self.owned()
        out: dict[int, dict[tuple, None]] = {}
        for g, o, t in zip(group, owner.tolist(), self._texts(begin, end), strict=True):
            salts = np.arange(1 << int(g & np.uint64(63)), dtype=np.uint64)
            for b in set(route(mix(g + salts), self.buckets).tolist()):
                out.setdefault(b, {})[int(g), o, t] = None
        return {b: list(x) for b, x in out.items()}

    def contexts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each range of windows: its number, the places of contested grams, the class of each place, and each class' bucket, least document and text."""
        a = self.a
        fought = self.is_[a.of] == FOUGHT
        level = self.level[a.of]
        for number, (lo, hi) in enumerate(RANGES):
            places = np.flatnonzero(fought & (level == np.searchsorted(_FIRST_RANGE, number, "right") - 1))
            if not len(places):
                continue
            rows = a.data[a.at[places][:, None] + np.arange(lo - SIDE, hi - SIDE + WINDOW)]
            bucket = route(_row_hash(rows[:, hi - lo : WINDOW]), self.buckets)
            who = a.own[a.doc[places]]
            order, new = _classes(rows, bucket, who)
            of = np.empty(len(places), np.int64)
            of[order] = np.cumsum(new) - 1
            one = order[new]
            yield number, places, of, bucket[one], who[one], rows[one]


def _classes(rows: np.ndarray, bucket: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket and text, in each text by document, and where a new text begins; texts are compared as text."""
    h = _row_hash(rows)
    order = np.lexsort((who, h, bucket))
    new = first_of_runs(bucket[order]) | first_of_runs(h[order])
    same = np.flatnonzero(~new)
    new[same] = (rows[order[same]] != rows[order[same - 1]]).any(1)
    return order, new


def _listed(texts: list[tuple]) -> tuple[np.ndarray, ...]:
    """Groups, owners, lengths and joined bytes of a list of (group, owner, text)."""
    g, o, t = zip(*texts, strict=True) if texts else ((), (), ())
    return np.array(g, np.uint64), np.array(o, np.uint64), np.array([len(x) for x in t], np.uint64), np.frombuffer(b"".join(t), np.uint8)


def _unlisted(group: np.ndarray, owner: np.ndarray, length: np.ndarray, data: np.ndarray) -> list[tuple]:
    whole, ends = data.tobytes(), np.cumsum(length).tolist()
    return [(g, o, whole[e - n : e]) for g, o, n, e in zip(group.tolist(), owner.tolist(), length.tolist(), ends, strict=True)]


def _meet(buckets: int):
    """Contexts of range r go to bucket k as payloads that begin with [r]; offers and claims to bucket buckets + k."""

    def run(row, got):
        out = []
        if row is not None:
            m = Meeting(Anchors(row, buckets), got, buckets)
            for number, _, _, bucket, least, rows in m.contexts():
                out += [(k, squeeze(np.array([number]), least[part], rows[part].ravel())) for k, part in split(bucket, buckets)]
            claims, offers = m.claimed()[2], m.offered()
            out += [(buckets + k, squeeze(*_listed(offers.get(k, [])), *_listed(claims.get(k, [])))) for k in sorted(claims.keys() | offers.keys())]
        b, p = zip(*out, strict=True) if out else ((), ())
        return pa.table({"bucket": pa.array(b, pa.int64()), "block": pa.array([row["block"]] * len(b) if b else [], pa.int64()), "payload": pa.array(p, pa.binary())})

    return run


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for word in wide.view("<u8").T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word)
    return out


def first_documents(rows: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each context, or part of one, the first document of each of its windows, NEVER for windows that leave their text.

    Rows that share what all windows of the range share are in one index; an index holds many such groups, up to INDEXED
    bytes, and a group beyond that is split by halves of the range.
    """
    order, new = _classes(rows, np.zeros(len(rows), np.int64), least)
    back = np.empty(len(rows), np.int64)
    back[order] = np.cumsum(new) - 1
    distinct, owner = rows[order[new]], least[order[new]]
    return _first_documents(distinct, owner)[back]


def _first_documents(rows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    span = rows.shape[1] - WINDOW + 1
    # a row's own document holds its windows, but for those that leave their text
    outside = (rows == NOT).cumsum(1, dtype=np.int16)
    outside[:, WINDOW:] -= outside[:, : span - 1].copy()
    clear = outside[:, WINDOW - 1 :] == 0
    out = np.where(clear, owner[:, None], NEVER)
    if span == 1:  # the rows are the windows, and distinct
        return out
    key = _row_hash(rows[:, span - 1 : WINDOW])
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(first_of_runs(key[order]))
    of = np.empty(len(rows), np.int64)
    of[order] = np.cumsum(first_of_runs(key[order])) - 1
    # a group's smallest document loses nothing, and its largest takes nothing from the others
    streamed, indexed = owner != np.minimum.reduceat(owner[order], heads)[of], owner != np.maximum.reduceat(owner[order], heads)[of]
    some = order[(streamed | indexed)[order]]
    parts = max(1, -(-len(some) * rows.shape[1] // INDEXED))
    for _, mine in split(route(key[some], parts), parts):
        mine = some[mine]
        if rows[mine].size <= 2 * INDEXED:
            text, asked = mine[indexed[mine]], mine[streamed[mine]]
            out[asked] = np.where(clear[asked], np.minimum(out[asked], _found(rows[text], owner[text], rows[asked])), NEVER)
        else:
            half = (span - 1) // 2
            out[mine, : half + 1] = first_documents(rows[mine, : half + WINDOW], owner[mine])
            out[mine, half + 1 :] = first_documents(rows[mine, half + 1 :], owner[mine])
    return out


def _found(rows: np.ndarray, owner: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """For each window of the rows asked, streamed through the run-length index of other rows, the first document of its matches."""
    width = rows.shape[1]
    span = width - WINDOW + 1
    text = np.concatenate((rows, np.full((len(rows), 1), NOT, np.uint8)), 1).ravel()
    order, classes = suffix_ranks(text, WINDOW)
    starts = (np.arange(len(rows)) * (width + 1))[:, None] + np.arange(span)
    first = np.full(len(text), NEVER, np.uint64)
    np.minimum.at(first, classes[starts].ravel(), np.repeat(owner, span))
    lengths, places = RunIndex(text, order).statistics(asked)
    return np.where(lengths[:, :span] >= WINDOW, first[classes[places[:, :span]]], NEVER)


def repeats(offers: list[tuple[int, bytes]], claims: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """offers and claims: (owner, text). For each claim the starts of its windows that its owner, or a smaller document, holds."""
    owner = np.array([o for o, _ in offers], np.uint64)
    length = np.array([len(t) for _, t in offers], np.int64)
    text = np.frombuffer(bytes([NOT]).join([t for _, t in offers]) + bytes([NOT]), np.uint8)
    order, classes = suffix_ranks(text, WINDOW)
    index = RunIndex(text, order)
    begin = np.cumsum(length + 1) - length - 1
    first = np.full(int(classes.max()) + 1, NEVER, np.uint64)
    inside = covered(len(text), begin[length >= WINDOW], (begin + length - WINDOW + 1)[length >= WINDOW])
    starts = np.flatnonzero(inside)
    np.minimum.at(first, classes[starts], owner[np.searchsorted(begin, starts, "right") - 1])
    cuts = [(k, at) for k, (_, t) in enumerate(claims) for at in range(0, len(t) - WINDOW + 1, STREAMED)]
    out: list[list[np.ndarray]] = [[] for _ in claims]
    for lo in range(0, len(cuts), 1 << 13):
        some = cuts[lo : lo + (1 << 13)]
        wide = STREAMED + WINDOW - 1
        rows = np.frombuffer(b"".join([claims[k][1][at : at + wide].ljust(wide, bytes([NOT])) for k, at in some]), np.uint8).reshape(-1, wide)
        lengths, places = index.statistics(rows)
        held = (lengths[:, :STREAMED] >= WINDOW) & (first[classes[places[:, :STREAMED]]] <= np.array([claims[k][0] for k, _ in some], np.uint64)[:, None])
        for (k, at), mine in zip(some, held, strict=True):
            hit = np.flatnonzero(mine) + at
            out[k].append(hit[hit <= len(claims[k][1]) - WINDOW])
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def _judge(asked) -> Iterator[tuple[int, bytes]]:
    """Streams the claims of a bucket through the indexes of its owners; a text that several blocks claim is streamed once."""
    offers: dict[int, dict[tuple, None]] = {}
    claims: dict[int, dict[tuple, np.ndarray]] = {}
    lists = [(block, _unlisted(*x[:4]), _unlisted(*x[4:])) for block, x in asked]
    for _, offered, claimed in lists:
        for g, o, t in offered:
            offers.setdefault(g, {})[o, t] = None
        for g, o, t in claimed:
            claims.setdefault(g, {})[o, t] = np.zeros(0, np.int64)
    held, size = [], 0
    groups = [g for g in offers if g in claims]
    for k, g in enumerate(groups):
        held.append(g)
        size += sum(len(t) + 1 for _, t in offers[g])
        if size >= INDEXED or k == len(groups) - 1:
            mine = [(h, c) for h in held for c in claims[h]]
            for (h, c), hits in zip(mine, repeats([x for h in held for x in offers[h]], [c for _, c in mine]), strict=True):
                claims[h][c] = hits
            held, size = [], 0
    for block, _, claimed in lists:
        # runs of windows as begin and end
        runs = [(hits[first], hits[last] + WINDOW) for g, o, t in claimed for hits in (claims[g][o, t],) for first, last in (_run_ends(hits),)]
        if any(len(b) for b, _ in runs):
            begin, end = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
            yield block, squeeze(np.array([len(b) for b, _ in runs]), begin, end - begin)


def _run_ends(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.ones(len(hits), bool)
    new[1:] = np.diff(hits) > 1
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(hits))[: len(first)] - 1


def _resolve(buckets: int):
    def run(bucket, asked):
        if bucket >= buckets:
            yield from _judge(asked)
            return
        for number in sorted({int(x[0][0]) for _, x in asked}):
            mine = [(block, x) for block, x in asked if int(x[0][0]) == number]
            lo, hi = RANGES[number]
            found = first_documents(np.concatenate([x[2].reshape(-1, hi - lo + WINDOW) for _, x in mine]), np.concatenate([x[1] for _, x in mine]))
            at = 0
            for block, x in mine:
                some = found[at : at + len(x[1])]
                at += len(x[1])
                # window by window, so that runs of equal answers compress; NEVER as 0, documents from 1
                yield block, squeeze(np.array([number]), (some.T + np.uint64(1)).ravel())

    return run


def _removed(m: Meeting, got: dict) -> np.ndarray:
    """Mask of the bytes of the block's data that are removed."""
    a, buckets = m.a, m.buckets
    starts, ends = [], []
    (begin, _, _, _, bucket), number, lists = m.claimed()
    for b in lists:
        if x := got.get(2 * buckets + b):
            count, at, length = (y.astype(np.int64) for y in x[0])
            cuts = np.append(0, np.cumsum(count))
            for k in np.flatnonzero(bucket == b):
                some = slice(cuts[number[k]], cuts[number[k] + 1])
                starts.append(begin[k] + at[some])
                ends.append(begin[k] + at[some] + length[some])
    answers = {(k - buckets, int(x[0][0])): x[1] for k in got if buckets <= k < 2 * buckets for x in got[k]}
    for number, places, of, bucket, _, _ in m.contexts():
        lo, hi = RANGES[number]
        found = np.concatenate([answers[k, number].reshape(hi - lo + 1, -1).T for k, _ in split(bucket, buckets)]) - np.uint64(1)
        for at in range(0, len(places), 1 << 16):
            some = places[at : at + (1 << 16)]
            r, j = np.nonzero(found[of[at : at + (1 << 16)]] < a.own[a.doc[some]][:, None])
            here = a.at[some][r] - SIDE + lo + j
            starts.append(here)
            ends.append(here + WINDOW)
    none = np.zeros(0, np.int64)
    return covered(len(a.data), np.concatenate((none, *starts)), np.concatenate((none, *ends)))


def _apply(buckets: int, texts: bool, carry: dict[str, pa.DataType]):
    def run(row, got):
        if row is None:
            names = [x.split() for x in SCHEMA.split(", ")]
            return pa.table({n: pa.array([], {"long": pa.int64(), "string": pa.string()}[t]) for n, t in names} | ({"kept": pa.array([], pa.string())} if texts else {}) | {k: pa.array([], t) for k, t in carry.items()})
        a = Anchors(row, buckets)
        gone = _removed(Meeting(a, got, buckets), got)
        kept, shas, removed, spans = [], [], [], []
        edge = np.diff(gone.view(np.int8), prepend=np.int8(0)) == 1
        for lo, hi in zip(a.head.tolist(), a.stop.tolist(), strict=True):
            mine = gone[lo:hi]
            removed.append(int(mine.sum()))
            spans.append(int(edge[lo:hi].sum()))
            body = (a.data[lo:hi] if not removed[-1] else a.data[lo:hi][~mine]).tobytes()
            shas.append(hashlib.sha256(body).hexdigest())
            if texts:
                kept.append(body.decode("utf-8", "ignore"))
        out = {"doc_id": id_column(row), "n_bytes": pa.array(a.stop - a.head), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.string())} if texts else {}) | (dict(zip(carry, carried(row), strict=True)) if carry else {}))

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """What each text loses and the checksum of what it keeps; with texts, also what is kept; letters that a cut leaves in part go too.

    carry: further columns to keep, without a join.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {c: to_arrow_type(docs.schema[c].dataType) for c in carry}
    blocks = make_blocks(docs, id_col, text_col, carry)
    buckets = bucket_count(blocks)
    spark = docs.sparkSession
    settled = answer(spark, lambda: send(blocks, _grams(buckets)), buckets, _settle)
    judged = answer(spark, lambda: rejoin(blocks, settled, _meet(buckets), SENT), 2 * buckets, _resolve(buckets))
    # in the second answers contexts are buckets 0.., claims buckets.. of their own
    both = settled.unionByName(judged.withColumn("bucket", F.col("bucket") + buckets))
    schema = SCHEMA + (", kept string" if texts else "") + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rejoin(blocks, both, _apply(buckets, texts, kinds), schema)
