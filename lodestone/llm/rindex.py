"""A run-length index: the run-compressed Burrows-Wheeler transform of a text with its suffix array sampled at run ends.

Patterns are streamed through it from right to left, many at once, and give their matching statistics: for each position
the length of its longest match in the text and one place of it. Where the transform goes on with another letter than the
pattern, the stream jumps to the nearest run of the right letter on the side of the longer common extension; both run
ends are sampled, so the place is known again at once.

The text's last letter separates the texts that it is made of. Suffixes are ordered up to their first separator, and those
equal up to there by place, so the order of two suffixes never depends on what comes after their texts; patterns never
match a separator.
"""

from __future__ import annotations

import numpy as np

PACKED = 43  # bits of the first key
PLACES = 21  # bits of a place or rank in a packed key


def suffix_ranks(text: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes by prefix doubling, and for each position the class of its next `keep` bytes, its own where these hold a separator.

    After each doubling only suffixes that are still equal to another are sorted on.
    """
    n = len(text)
    used = np.zeros(256, np.int64)
    used[text] = 1
    code = np.cumsum(used)  # letters keep their order, and nothing at all comes before them
    wide = int(code[-1] + 1).bit_length()
    depth = min(PACKED // wide, keep - 1)
    letter = code[text].astype(np.uint64)
    ends = np.append(np.flatnonzero(text == text[-1]), n)
    left = np.repeat(ends, np.diff(ends, prepend=-1))[:n] - np.arange(n)  # letters before the separator
    key = np.zeros(n, np.uint64)
    for k in range(depth):
        key <<= np.uint64(wide)
        key[: max(0, n - k)] += letter[k:]
    near = np.flatnonzero(left < depth)
    past = ((depth - 1 - left[near]) * wide).astype(np.uint64)
    key[near] = key[near] >> past << past
    order, key = _sorted(key)
    # a suffix whose key holds its separator is told from all others by its place
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    new |= left[order] < depth
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    classes = None
    while True:
        slots = _tied(new)
        if classes is None and 2 * depth >= keep:
            classes = rank.copy()
            _refine(order.copy(), classes, slots, keep - depth)
        if not len(slots):
            return order, rank if classes is None else classes
        new = _refine(order, rank, slots, depth)
        depth *= 2


def _tied(new: np.ndarray) -> np.ndarray:
    """Slots of an order whose suffix is equal to the one before or after it."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return np.flatnonzero(~alone)


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, equal ones by place, and the keys in that order."""
    n = len(key)
    if n < 1 << PLACES:
        both = np.sort(key << np.uint64(PLACES) | np.arange(n, dtype=np.uint64))
        return (both & np.uint64((1 << PLACES) - 1)).astype(np.int64), both >> np.uint64(PLACES)
    order = np.argsort(key, kind="stable")
    return order, key[order]


def _refine(order: np.ndarray, rank: np.ndarray, slots: np.ndarray, by: int) -> np.ndarray:
    """Sorts the suffixes in these slots on by the ranks `by` places ahead; order and rank change, the result marks where a new rank begins."""
    n = len(rank)
    place = order[slots]
    ahead = np.minimum(place + by, n - 1)  # past the end there is none: such a suffix has met its separator
    if n < 1 << PLACES:
        key = rank[place].astype(np.uint64) << np.uint64(PLACES) | rank[ahead].astype(np.uint64)
        inner, key = _by_key(key)
    else:
        inner = np.lexsort((rank[ahead], rank[place]))
        key = rank[place][inner].astype(np.uint64) * np.uint64(n) + rank[ahead][inner].astype(np.uint64)
    order[slots] = place[inner]
    begins = np.ones(len(slots), bool)
    np.not_equal(key[1:], key[:-1], out=begins[1:])
    rank[order[slots]] = np.maximum.accumulate(np.where(begins, slots, 0))
    new = np.ones(n, bool)
    new[slots] = begins
    return new


def _by_key(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.uint64(max(1, len(key).bit_length()))
    both = np.sort(key << bits | np.arange(len(key), dtype=np.uint64))
    return (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), both >> bits


class RunIndex:
    def __init__(self, text: np.ndarray, order: np.ndarray) -> None:
        """order: the suffix array of the text; it is not kept, only its samples are."""
        self.text = text
        self.words = np.ndarray((len(text),), "<u8", np.concatenate((text, np.zeros(8, np.uint8))), strides=(1,))
        bwt = text[order - 1]  # the letter before the first is the last
        self.start = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))
        letter = bwt[self.start]
        self.letter = letter.astype(np.int64)
        marks = np.zeros(len(bwt), np.int32)
        marks[self.start] = 1
        self.run_of = np.cumsum(marks, dtype=np.int32) - 1  # rank over the marks of run starts
        self.end = np.append(self.start[1:], len(bwt)) - 1
        self.at_start, self.at_end = order[self.start], order[self.end]
        self.by_letter = np.argsort(letter, kind="stable")
        length = (self.end - self.start + 1)[self.by_letter]
        # LF maps each run to one range: runs of a letter follow each other in the first column
        image = np.empty(len(self.start), np.int64)
        image[self.by_letter] = np.cumsum(length) - length
        self.shift = image - self.start
        self.keys = self.letter[self.by_letter] * len(self.start) + self.by_letter

    @property
    def runs(self) -> int:
        return len(self.start)

    def _extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common bytes of the text from a and from b, up to most: eight at a time, then those of the first eight that differ."""
        most = np.minimum(most, len(self.text) - np.maximum(a, b))
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            differ = self.words[a[live] + out[live]] ^ self.words[b[live] + out[live]]
            low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
            out[live] += np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3)
            live = live[(differ == 0) & (out[live] < most[live])]
        return np.minimum(out, np.maximum(most, 0))

    def statistics(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """patterns: one in each row, all of one length. Lengths and places of the longest match at each position."""
        count, width = patterns.shape
        lengths, places = np.empty((width, count), np.int64), np.empty((width, count), np.int64)
        row = np.zeros(count, np.int64)  # in the transform
        place = np.full(count, self.at_start[0])
        length = np.zeros(count, np.int64)
        columns = np.ascontiguousarray(patterns.T).astype(np.int64)
        for j in range(width - 1, -1, -1):
            c = columns[j]
            run = self.run_of[row]
            off = np.flatnonzero(self.letter[run] != c)
            if len(off):
                want = c[off]
                k = np.searchsorted(self.keys, want * self.runs + run[off])
                before, after = np.maximum(k - 1, 0), np.minimum(k, self.runs - 1)
                r0, r1 = self.by_letter[before], self.by_letter[after]
                has0, has1 = (k > 0) & (self.letter[r0] == want), (k < self.runs) & (self.letter[r1] == want)
                most = length[off]
                e0 = np.where(has0, self._extension(place[off], self.at_end[r0], most), -1)
                e1 = np.where(has1, self._extension(place[off], self.at_start[r1], most), -1)
                first = e0 >= e1
                run[off] = np.where(first, r0, r1)
                row[off] = np.where(first, self.end[r0], self.start[r1])
                place[off] = np.where(first, self.at_end[r0], self.at_start[r1])
                length[off] = np.where(first, e0, e1)
            row += self.shift[run]
            place -= 1
            length += 1
            lost = np.flatnonzero((length <= 0) | (c == self.text[-1]) | (place < 0))  # a letter that the text lacks, or the separator
            row[lost], place[lost], length[lost] = 0, self.at_start[0], 0
            lengths[j], places[j] = length, place
        return lengths.T, places.T
