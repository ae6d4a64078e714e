"""Shared helpers of the training-data operators: byte-level views of Arrow text, hashing, packing and partition counts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: The white space of the contracts: \x20 and \x09-\x0D.
WS = b" \t\n\x0b\x0c\r"
IS_WS = np.zeros(256, bool)
IS_WS[list(WS)] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW = np.ones(1, np.uint64)
_IPOW = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix) over an array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _IPOW
    if len(_POW) < n:
        n = 1 << (n - 1).bit_length()
        for seed, name in ((_BASE, "_POW"), (_INV, "_IPOW")):
            out = np.full(n, seed & ((1 << 64) - 1), np.uint64)
            out[0] = 1
            globals()[name] = np.multiply.accumulate(out)
    return _POW, _IPOW


LONG = 64  # bytes of a range that is hashed by the library, not eight bytes at a time over all ranges
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges of any length, equal for equal bytes. Every eight bytes pass a finaliser, so no family of texts is known to collide."""
    size = end - start
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    words = np.ndarray((len(data),), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= LONG))
    at, left = start[live], size[live]
    while len(live):
        word = words[at]
        part = np.flatnonzero(left < 8)
        word[part] &= _MASK[left[part]]
        out[live] = mix(out[live] * np.uint64(0xD6E8FEB86659FD93) + word)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    far = np.flatnonzero(size > LONG)
    if len(far):
        whole, h = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_64_intdigest
        out[far] = [h(whole[a:b]) for a, b in zip(start[far].tolist(), end[far].tolist(), strict=True)]
    return out


class RangeHash:
    """Rolling polynomial hash over one byte buffer: the hash of any range in constant time, equal for equal bytes.

    For ranges under MOST bytes only: modulo 2^64, whatever the base, some different texts of 1024 letters hash alike.
    """

    MOST = 512

    def __init__(self, data: np.ndarray) -> None:
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer whose last byte is white space."""
    inside = (~IS_WS[data]).view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def text_bytes(column: pa.Array, pad: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts (null: empty) as one buffer, each followed by pad, and the offsets (n + 1) of the padded texts."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    joined = pc.binary_join_element_wise(column, pa.scalar(pad, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
    if not len(joined) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(joined) + 1, np.int64)
    data = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(column: pa.Array, pad: bytes = b"\n", most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts in runs of about `most` bytes (a longer text stands alone): first row, end row, buffer, offsets in it."""
    data, offsets = text_bytes(column, pad)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def first_of_runs(keys: np.ndarray) -> np.ndarray:
    """Mask of the first element of each run of equal values."""
    out = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=out[1:])
    return out


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the values found twice or more."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s), bool)
    if len(s) > 1:
        eq = s[1:] == s[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    out = np.zeros(len(s), bool)
    out[order] = same
    return out


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the positions of 0..n-1 inside any [start, end)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1) if len(starts) < 64 else d.__iadd__(np.bincount(starts, minlength=n + 1).astype(np.int32))
    np.subtract.at(d, ends, 1) if len(ends) < 64 else d.__isub__(np.bincount(ends, minlength=n + 1).astype(np.int32))
    return np.cumsum(d[:-1], dtype=np.int32) > 0


def give_back() -> None:
    """Returns memory that is free again to the system. Python workers live on for later stages, and would keep the most that any took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def tidy(run):
    """An Arrow iterator function that gives memory back at the end of its task."""

    def over(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return over


BATCH_BYTES = 8 << 20


def bounded_batches(spark) -> None:
    """Arrow batches of at most BATCH_BYTES, unless the session has them smaller: a batch of long texts is then no larger than one of short ones."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    size = int(now.rstrip("b")) if now and now.rstrip("b").isdigit() else None
    if size is None or size <= 0 or size > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def shuffle_parts(spark) -> int:
    """Partitions of a shuffle, as the session is set."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def ensure_checkpoint_dir(spark) -> None:
    """Uses the shared folder that the cluster names in spark.checkpoint.dir; a folder of our own only where none is set, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="lodestone-checkpoint-")
    sc.setCheckpointDir(folder)
