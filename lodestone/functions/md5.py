"""MD5 of very many short messages at once: a hash for each shingle of a text is too many calls of a library, one for each."""

from __future__ import annotations

import hashlib
import math

import numpy as np

SHORT = 55  # bytes of a message that is one block
CHUNK = 8192  # messages worked on at once
TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
ADDED = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
PLACES = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
KEPT = ((np.arange(56) < np.arange(56)[:, None]) * 255).astype(np.uint8).view(np.uint64)  # by size: a message's own bytes
CLOSED = ((np.arange(56) == np.arange(56)[:, None]) * 128).astype(np.uint8).view(np.uint64)


def _block(windows: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    x = np.zeros((16, len(lo)), np.uint32)
    x[:14] = ((windows[lo].view(np.uint64) & KEPT[size]) | CLOSED[size]).view(np.uint32).T
    x[14] = size * 8
    a, b, c, d = (np.full(len(lo), v) for v in START)
    for i in range(64):
        if i < 16:
            f = d ^ (b & (c ^ d))
        elif i < 32:
            f = c ^ (d & (b ^ c))
        elif i < 48:
            f = b ^ c ^ d
        else:
            f = c ^ (b | ~d)
        f += a
        f += x[PLACES[i]]
        f += ADDED[i]
        turn = TURNS[i // 16][i % 4]
        high = f << np.uint32(turn)
        f >>= np.uint32(32 - turn)
        f |= high
        f += b
        a, b, c, d = d, f, b, c
    return (a + START[0]).byteswap()


def heads(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The first 8 hex digits, as numbers, of the MD5 of data[lo:hi] (bytes) for each lo and hi."""
    out, size = np.empty(len(lo), np.uint32), hi - lo
    windows = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(56, np.uint8)), 56)
    short = np.flatnonzero(size <= SHORT)
    for at in range(0, len(short), CHUNK):
        mine = short[at : at + CHUNK]
        out[mine] = _block(windows, lo[mine], size[mine])
    for i in np.flatnonzero(size > SHORT):
        out[i] = int.from_bytes(hashlib.md5(data[lo[i] : hi[i]].tobytes(), usedforsecurity=False).digest()[:4], "big")
    return out
