"""Leading rows of each group, with their ties counted, by a bit-sliced bitmap index.

Each block of up to BLOCK rows of one partition is indexed where it lies. Its rows are put in the order of their groups, so
that a group's bitmap is one run of bits, and the pair by which rows are ranked becomes bit slices: one bitmap for each bit of
each pair column, most significant first (a column that holds nulls has a slice for them before its bits, so nulls come last). For
STEP slices at a time a block ands its candidates with the slices and their complements and sends each bucket of groups the
popcounts of each group's run, packed. A bucket sums the popcounts of all blocks, descends bit by bit to where the group's
k-th row must lie, and answers each block. A group leaves the descent as soon as what is left is no more than what is sought; after the last
slice its cutoff pair is exact, and so is the popcount of the rows that share it, however many. Then the rows up to the cutoff are
fetched: of each block at most k of a group, merged in ranges of FAN blocks until one range is left.

A group is one entry of a block's payload, whatever its size, so a group with a third of all rows burdens no task more than
another; nothing goes to the driver but the least and largest value of each pair column, and nothing is broadcast.

Cases: a null in a group column is a value of its own. Nulls of pair columns come last and are equal to each other; nulls of the
columns that break ties come last. Equal rows are ranked separately, each with a place of its own. A group of fewer than k rows is returned whole.
An empty table gives an empty table. Further columns are not read, and may clash with the operator's own names.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import SENT, answer, packed, rejoin, route, send, split, squeeze, unsqueeze
from .common import bounded_batches, ensure_checkpoint_dir, first_of_runs, mix, shuffle_parts, tidy

BLOCK = 1 << 19  # rows of an index
STEP = 4  # slices whose popcounts are sent at once
BUCKET = 1 << 20  # rows for each bucket of groups
FAN = 64  # blocks whose leading rows meet in one range

INDEX = "block long, groups binary, slices binary, rows binary"


def _zigzag(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) << 1 ^ v.astype(np.int64) >> 63).view(np.uint64)


def bitmap(mask: np.ndarray) -> np.ndarray:
    """A mask as 64-bit words, with a word of zeros at the end."""
    out = np.zeros(len(mask) // 64 + 1, np.uint64)
    packed = np.packbits(mask, bitorder="little")
    out.view(np.uint8)[: len(packed)] = packed
    return out


def popcounts(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bits set in each run [start, end) of a bitmap."""
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def before(at: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return total[at >> 6] + np.bitwise_count(words[at >> 6] & below)

    return before(end) - before(start)


@dataclass(frozen=True)
class PairColumn:
    """How a pair column becomes slices."""

    least: int
    largest: int
    nulls: bool
    down: bool

    @property
    def bits(self) -> int:
        return max(1, (self.largest - self.least).bit_length())

    def slices(self, values: np.ndarray, null: np.ndarray) -> Iterator[np.ndarray]:
        """Most significant first."""
        v, edge = values.view(np.uint64), np.uint64((self.largest if self.down else self.least) & (1 << 64) - 1)
        code = np.where(null, np.uint64(0), edge - v if self.down else v - edge)
        if self.nulls:
            yield bitmap(null)
        for bit in range(self.bits - 1, -1, -1):
            yield bitmap((code >> np.uint64(bit) & np.uint64(1)).astype(bool))


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


def _build(n_group: int, pair: list[PairColumn], buckets: int):
    """Index rows of blocks; columns: groups, pair, then the rest."""

    def index(number: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        cols, null = zip(*(_values(rows.column(k)) for k in range(n_group)), strict=True)
        nulls = sum(x.astype(np.uint64) << np.uint64(k) for k, x in enumerate(null))
        h = mix(nulls + np.uint64(1))
        for c in cols:
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + c.view(np.uint64))
        bucket = route(h, buckets)
        order = np.lexsort((*cols[::-1], nulls, h))
        cols, nulls, bucket, h = [c[order] for c in cols], nulls[order], bucket[order], h[order]
        new = first_of_runs(h) | first_of_runs(nulls)
        for c in cols:
            new |= first_of_runs(c)
        first = np.flatnonzero(new)
        groups = squeeze(np.diff(first, append=len(order)), bucket[first], nulls[first], *(_zigzag(c[first]) for c in cols))
        slices = [s.view(np.uint8) for k, p in enumerate(pair) for s in p.slices(*(x[order] for x in _values(rows.column(n_group + k))))]
        sink = io.BytesIO()
        kept = rows.take(pa.array(order))
        with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(kept)
        held = (groups, squeeze(*slices), sink.getvalue())
        return pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([x], pa.binary()) for x in held)], ["block", "groups", "slices", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            return index(number, pa.Table.from_batches(held).combine_chunks().to_batches()[0])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - size)
                batch = batch.slice(part.num_rows)
                held.append(part)
                size += part.num_rows
                if size == BLOCK:
                    yield block()
                    number, held, size = number + 1, [], 0
        if held:
            yield block()

    return run


class Index:
    """A block's groups, where they stand in the descent, and its slices."""

    def __init__(self, row: dict, got: dict, buckets: int, most: int, rounds: int) -> None:
        run, bucket, self.nulls, *self.cols = unsqueeze(row["groups"])
        self.run, self.bucket = run.astype(np.int64), bucket.astype(np.int64)
        self.end = np.cumsum(self.run)
        self.start = self.end - self.run
        self.slices = [s.view(np.uint64) for s in unsqueeze(row["slices"])]
        n = len(run)
        self.live, self.need = np.ones(n, bool), np.full(n, most, np.uint64)
        self.path = np.zeros((rounds, n), np.uint64)  # the pattern of each step's slices at the cutoff
        self.steps, self.same = np.zeros(n, np.int64), np.zeros(n, np.int64)  # steps taken; rows of the cutoff pair, if it is exact
        for r in range(rounds):
            for k, part in split(self.bucket, buckets):
                mine = np.flatnonzero(self.live[part]) + part.start
                if len(mine):
                    pattern, need, over, same = got[r * buckets + k][0]
                    self.path[r, mine], self.need[mine], self.same[mine] = pattern, need, same
                    self.steps[mine] = r + 1
                    self.live[mine[over > 0]] = False

    def spread(self, of_groups: np.ndarray) -> np.ndarray:
        """A mask of groups as the bitmap of their rows."""
        return bitmap(np.repeat(of_groups, self.run))

    def step(self, r: int) -> list[tuple[int, np.ndarray]]:
        """The slices of step r, each with its bit in the pattern."""
        some = self.slices[r * STEP : (r + 1) * STEP]
        return [(len(some) - 1 - k, s) for k, s in enumerate(some)]

    def at_cutoff(self, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the rows before the cutoff as far as it is known, and of those at it."""
        at = self.spread(np.ones(len(self.run), bool))
        before = np.zeros_like(at)
        for r in range(rounds):
            on = self.spread(self.steps > r)
            for bit, s in self.step(r):
                want = self.spread((self.path[r] >> np.uint64(bit) & np.uint64(1)).astype(bool))
                before |= at & on & want & ~s
                at = at & (~(s ^ want) | ~on)
        return before, at


def _ask(buckets: int, most: int, r: int):
    """Step r: popcounts of the live groups' candidates, by pattern of the step's slices."""

    def run(row: dict, got: dict) -> Iterator[tuple[int, bytes]]:
        x = Index(row, got, buckets, most, r)
        nodes = [x.at_cutoff(r)[1] & x.spread(x.live)]
        for _, s in x.step(r):
            nodes = [y for node in nodes for y in (node & ~s, node & s)]
        for k, part in split(x.bucket, buckets):
            mine = np.flatnonzero(x.live[part]) + part.start
            if len(mine):
                count = np.stack([popcounts(node, x.start[mine], x.end[mine]) for node in nodes], 1)
                there = count > 0
                which = (there.astype(np.uint64) << np.arange(len(nodes), dtype=np.uint64)).sum(1, dtype=np.uint64)
                yield k, squeeze(x.nulls[mine], which, count[there], x.need[mine], *(c[mine] for c in x.cols))

    return run


def _sends(ask):
    def run(row: dict | None, got: dict) -> pa.Table:
        return pa.Table.from_batches([packed(((b, row["block"], p) for b, p in ask(row, got)) if row else (), ("bucket", "block"))])

    return run


def descend(count: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit by bit to the pattern where each group's need-th candidate lies: the pattern, what is still sought there, and its candidates.

    count: popcounts by group and pattern.
    """
    before = np.concatenate((np.zeros((len(count), 1), np.int64), np.cumsum(count, axis=1)), 1)
    low, span, row, need = np.zeros(len(count), np.int64), count.shape[1], np.arange(len(count)), need.astype(np.int64)
    while span > 1:
        span //= 2
        zeros = before[row, low + span] - before[row, low]
        ones = zeros < need  # too few have a zero here
        need = np.where(ones, need - zeros, need)
        low = np.where(ones, low + span, low)
    return low, need, before[row, low + 1] - before[row, low]


def _decide(patterns: int, last: bool):
    def run(bucket: int, asked) -> Iterator[tuple[int, bytes]]:
        nulls, which, _, need, *cols = (np.concatenate([x[k] for _, x in asked]) for k in range(len(asked[0][1])))
        order = np.lexsort((*cols, nulls))
        new = first_of_runs(nulls[order])
        for c in cols:
            new |= first_of_runs(c[order])
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        total = np.zeros((int(of.max()) + 1, patterns), np.int64)
        there = (which[:, None] >> np.arange(patterns, dtype=np.uint64) & np.uint64(1)).astype(bool)
        entry, pattern = np.nonzero(there)
        np.add.at(total, (of[entry], pattern), np.concatenate([x[2] for _, x in asked]).astype(np.int64))
        low, left, same = descend(total, need[order[new]])
        over = (same <= left) | last
        at = 0
        for block, x in asked:
            mine = of[at : at + len(x[0])]
            at += len(x[0])
            yield block, squeeze(low[mine], left[mine], over[mine], (same * last)[mine])

    return run


def _fetch(buckets: int, most: int, rounds: int, n_group: int, n_pair: int, schema: pa.Schema):
    """The rows up to the cutoff, of each group at most the block's first."""

    def run(row: dict | None, got: dict) -> pa.Table:
        if row is None:
            return schema.empty_table()
        x = Index(row, got, buckets, most, rounds)
        before, at = x.at_cutoff(rounds)
        n = int(x.end[-1])
        here = np.flatnonzero(np.unpackbits((before | at).view(np.uint8), bitorder="little")[:n])
        rows = pa.ipc.open_stream(row["rows"]).read_all().combine_chunks().take(pa.array(here))
        group = np.repeat(np.arange(len(x.run)), x.run)[here]
        keys = [k for c in rows.columns[n_group + n_pair :] for k in _values(c.combine_chunks())[::-1]]  # nulls of a column after its values
        pair = [np.unpackbits(s.view(np.uint8), bitorder="little")[:n][here] for s in x.slices]
        order = np.lexsort((*keys[::-1], *pair[::-1], group))
        group = group[order]
        first = np.flatnonzero(first_of_runs(group))
        place = np.arange(len(group)) - np.repeat(first, np.diff(first, append=len(group)))
        kept = order[place < most]
        exact = np.unpackbits(at.view(np.uint8), bitorder="little")[:n][here][kept].astype(bool)
        same = x.same[np.repeat(np.arange(len(x.run)), x.run)[here][kept]]
        same = pa.array(same, pa.int64(), mask=~exact | (same == 0))
        return pa.table([*rows.take(pa.array(kept)).columns, same, pa.array(np.full(len(kept), row["block"]))], schema=schema)

    return run


def leading_rows(rows: DataFrame, group: tuple[str, ...], pair: tuple[tuple[str, bool], ...], ties: tuple[str, ...], most: int) -> DataFrame:
    """The columns named, pos (from 1) and tied (rows of the group with this row's pair) of the first `most` rows of each group.

    pair: columns that rank rows, each with whether larger values come first. ties: columns that then break ties, ascending. All are integers of at most 64 bits.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    bounded_batches(spark)
    names = (*group, *(c for c, _ in pair), *ties)
    own = [f"c{k}" for k in range(len(names))]  # a column may be in two roles
    chosen = rows.select(*[rows[c].cast("long").alias(o) for c, o in zip(names, own, strict=True)])
    n_group, n_pair = len(group), len(pair)
    of_pair = own[n_group : n_group + n_pair]
    ends = chosen.agg(F.count("*").alias("n"), *[f(c).alias(f"{k}{c}") for c in of_pair for k, f in (("least", F.min), ("largest", F.max), ("there", F.count))]).first()
    kinds = [PairColumn(ends[f"least{c}"] or 0, ends[f"largest{c}"] or 0, ends[f"there{c}"] < ends["n"], down) for c, (_, down) in zip(of_pair, pair, strict=True)]
    wide = sum(k.bits + k.nulls for k in kinds)
    rounds = -(-wide // STEP)
    buckets = max(shuffle_parts(spark), -(-ends["n"] // BUCKET))
    index = chosen.mapInArrow(tidy(_build(n_group, kinds, buckets)), INDEX).checkpoint()
    slim, answers = index.select("block", "groups", "slices"), None
    for r in range(rounds):
        ask = _ask(buckets, most, r)
        patterns = 1 << min(STEP, wide - r * STEP)
        decide = _decide(patterns, r + 1 == rounds)
        if answers is None:
            found = answer(spark, lambda ask=ask: send(slim, lambda row: ask(row, {})), buckets, decide)
        else:
            found = answer(spark, lambda ask=ask, answers=answers: rejoin(slim, answers, _sends(ask), SENT), buckets, decide)
        found = found.withColumn("bucket", F.col("bucket") + r * buckets)
        answers = found if answers is None else answers.unionByName(found)
    schema = pa.schema([*[(o, pa.int64()) for o in own], ("same", pa.int64()), ("block", pa.int64())])
    fetch = _fetch(buckets, most, rounds, n_group, n_pair, schema)
    out = ", ".join(f"{f.name} long" for f in schema)
    found = rejoin(index, answers, fetch, out)
    groups = own[:n_group]
    place = [*[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, (_, down) in zip(of_pair, pair, strict=True)], *[F.col(c).asc_nulls_last() for c in own[n_group + n_pair :]]]
    return _merged(found, groups, of_pair, place, most, index.count(), names, own)


def _merged(found: DataFrame, groups: list[str], pair: list[str], place: list[Column], most: int, blocks: int, names: tuple[str, ...], own: list[str]) -> DataFrame:
    """The first rows of each group: within ranges of blocks first, so that no task meets more than about FAN blocks' rows of one group."""
    ranges = 1
    while ranges * FAN < blocks:
        ranges *= FAN
    found = found.withColumn("part", F.xxhash64("block"))
    while ranges > 1:
        near = Window.partitionBy(*groups, F.pmod("part", F.lit(ranges))).orderBy(*place)
        found = found.withColumn("pos", F.row_number().over(near)).where(F.col("pos") <= most).drop("pos")
        ranges //= FAN
    ranked = found.withColumn("pos", F.row_number().over(Window.partitionBy(*groups).orderBy(*place)).cast("long")).where(F.col("pos") <= most)
    # rows before an exact cutoff, and all rows of a group that left the descent, are here with all that share their pair
    shared = F.count("*").over(Window.partitionBy(*groups, *pair))
    tied = ranked.withColumn("tied", F.coalesce("same", shared))
    seen, columns = set(), []
    for name, o in zip(names, own, strict=True):
        if name not in seen:
            seen.add(name)
            columns.append(F.col(o).alias(name))
    return tied.select(*columns, "pos", "tied")
