"""Byte-pair encodings as a lattice that is relaxed from left to right.

Two facts make an exact dynamic program: a row of tokens is an encoding exactly if each two neighbours, joined, encode to
themselves, and every prefix has one encoding. So for each prefix one token suffices, its last: the token that ends
there and is compatible with the last token of the prefix before it. All words of a batch are relaxed together, by length.
"""

from __future__ import annotations

import json

import numpy as np

from .common import RangeHash, mix

NEVER = np.int64(1) << 40


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the rest follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Which tokens exist, how each came about, and which pairs may stand side by side.

    pieces: the tokens' bytes (None: takes no part). splits: for each token its two parts, or itself for a base token.
    ranks: when a token is made, -1 for base tokens. pairs: (left, right, rank of the pair's merge).
    """

    SLOTS = 1 << 20

    def __init__(self, pieces: list[bytes | None], left: np.ndarray, right: np.ndarray, ranks: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.pieces, self.left, self.right, self.rank = pieces, left, right, ranks
        keys = pairs[0].astype(np.int64) << 20 | pairs[1]
        order = np.argsort(keys)
        self.keys, self.pair_rank = keys[order], pairs[2].astype(np.int64)[order]
        self.slot_key = np.full(self.SLOTS, -1, np.int64)
        self.slot_says = np.zeros(self.SLOTS, bool)
        known = [(k, p) for k, p in enumerate(pieces) if p]
        self.longest = max(len(p) for _, p in known)
        if self.longest >= RangeHash.MOST:
            raise ValueError(f"a piece of {self.longest} bytes is too long for the rolling hash")
        ends = np.cumsum([len(p) for _, p in known])
        hashes = RangeHash(np.frombuffer(b"".join(p for _, p in known), np.uint8)).of(ends - [len(p) for _, p in known], ends)
        order = np.argsort(hashes)
        self.hash, self.hash_token = hashes[order], np.array([k for k, _ in known])[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[hashes >> np.uint64(42)] = True

    @classmethod
    def byte_level(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], byte_letters()
        n = max(vocab.values()) + 1
        pieces: list[bytes | None] = [None] * n
        for word, k in vocab.items():
            pieces[k] = bytes(letters[c] for c in word)
        left, right, ranks = np.arange(n), np.arange(n), np.full(n, -1, np.int64)
        pairs = []
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            k = vocab[a + b]
            left[k], right[k], ranks[k] = vocab[a], vocab[b], rank
            pairs.append((vocab[a], vocab[b], rank))
        return cls(pieces, left, right, ranks, tuple(np.array(x) for x in zip(*pairs, strict=True)))

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.pair_rank[at], NEVER)

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges of both tokens from the last one on; no merge across the border may come before the one undone."""
        says = np.ones(len(a), bool)
        live, x, y, limit = np.arange(len(a)), a.copy(), b.copy(), np.full(len(a), NEVER)
        while len(live):
            broken = self._merge_rank(x, y) < limit
            says[live[broken]] = False
            rx, ry = self.rank[x], self.rank[y]
            of_x = rx > ry
            go = ~broken & (of_x | (ry >= 0))
            limit = np.where(of_x, rx, ry + 1)[go]
            x, y = np.where(of_x, self.right[x], x)[go], np.where(of_x, y, self.left[y])[go]
            live = live[go]
        return says

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        slot = (mix(key.view(np.uint64)) & np.uint64(self.SLOTS - 1)).astype(np.int64)
        miss = np.flatnonzero(self.slot_key[slot] != key)
        out = self.slot_says[slot]
        if len(miss):
            fresh, back = np.unique(key[miss], return_inverse=True)
            says = self._judge(fresh >> 20, fresh & ((1 << 20) - 1))
            out[miss] = says[back]
            at = (mix(fresh.view(np.uint64)) & np.uint64(self.SLOTS - 1)).astype(np.int64)
            _, one = np.unique(at, return_index=True)
            self.slot_key[at[one]], self.slot_says[at[one]] = fresh[one], says[one]
        return out

    def edges(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where tokens occur in the words: start, end (both as nodes), level of the end, token; and lengths through len(words)."""
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words)), size)
        head = np.cumsum(size) - size
        hashes = RangeHash(data)
        at = np.arange(len(data))
        room = (head + size)[word] - at
        found = []
        for n in range(1, min(self.longest, int(size.max(initial=0))) + 1):
            at = at[room[at] >= n]
            h = hashes.of(at, at + n)
            hit = np.flatnonzero(self.maybe[h >> np.uint64(42)])
            h = h[hit]
            where = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            real = self.hash[where] == h
            start = at[hit[real]]
            found.append((start + word[start], start + word[start] + n, start - head[word[start]] + n, self.hash_token[where[real]]))
        return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 4))

    def relax(self, size: np.ndarray, u: np.ndarray, v: np.ndarray, level: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes are the prefixes of every word (its length + 1 of them): the last token of each (-1: none), the count of tokens, and each word's first node."""
        first = np.cumsum(size + 1) - size - 1
        total = int((size + 1).sum())
        last, count = np.full(total, -1, np.int64), np.zeros(total, np.int64)
        last[first] = -2
        order = np.argsort(level, kind="stable")
        u, v, token, level = u[order], v[order], token[order], level[order]
        cuts = np.searchsorted(level, np.arange(1, int(level[-1]) + 2)) if len(level) else []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            a, t = last[u[lo:hi]], token[lo:hi]
            fits = a == -2
            inner = np.flatnonzero(a >= 0)
            fits[inner] = self.compatible(a[inner], t[inner])
            last[v[lo:hi][fits]] = t[fits]
            count[v[lo:hi][fits]] = count[u[lo:hi][fits]] + 1
        return last, count, first

    def prefix_counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The exact count of tokens of every prefix of every word, and where each word's counts begin."""
        size = np.array([len(w) for w in words], np.int64)
        last, count, first = self.relax(size, *self.edges(words))
        if (last == -1).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        return count, first
