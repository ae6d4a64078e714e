"""Language-model scores by an n-gram model with Katz backoff.

Counts of each length are discounted by Good-Turing: up to K by the count-of-counts, above by the amount that a count of K
loses. What a context loses goes to its unseen followers in proportion to the model of contexts one word shorter, so that
each context's probabilities sum to one exactly, at every order; the unigram model is discounted alike, and what it loses is
shared by the estimated number of unseen words. A text's first word has the start of a text as context, its second the start
and the first, and so on up to order - 1 words.

The tables stay partitioned: word buckets hold the counts of words, n-gram buckets the counts of the followers of their
contexts, one table for each length, and shorter ones are there before longer ones. Blocks of documents ask for what they
hold, and each token is evaluated by the recursion: its longest n-gram if that was seen, else the backoff weight of its
context times the same for the n-gram without its first word, down to the word alone, or the share of an unseen one. All
that a weight needs of the shorter model are the counts of the shorter n-grams, as these were seen wherever the longer were.

A context that one block alone holds needs no exchange: its followers are counted within the block. Contexts with very many
followers are dealt over all buckets by follower; only their sums (at most MOST_HOT contexts of a length) and the
count-of-counts reach the driver.

Cases: a null or empty text is one end token. Rows of null id train, as held_out is false for them. Repeated rows count as
often as they stand, and rows of one id are scored each. With nothing to learn from, all tokens are unseen. Scores are finite
for every text. Words and contexts are told apart by 64-bit hashes. An empty table gives an empty table; further columns are
not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import SENT, answer, bucket_count, id_column, make_blocks, nulls, rejoin, route, send, split, squeeze, unsqueeze
from .common import first_of_runs, mix, span_hashes, words_of

ORDER = 3  # words of the longest n-gram
K = 5  # counts above this lose as much as this one
FOLDS, HELD_OUT = 5, 1
HOT, MOST_HOT = 50_000, 100_000  # contexts seen more often than the larger of HOT and N / MOST_HOT are dealt by follower
END = np.uint64(0x5EED0000E0D00001)
START = np.uint64(0)  # as a context's name

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass(frozen=True)
class Discounts:
    """Good-Turing discounts of counts, from how many things were seen once, twice, ..., K + 1 times."""

    keep: tuple[float, ...]  # share kept of counts 1..K

    @classmethod
    def of(cls, times: np.ndarray) -> Discounts:
        n = np.maximum(np.asarray(times, float), 0)
        common = (K + 1) * n[K] / n[0] if n[0] else 1.0
        keep = []
        for r in range(1, K + 1):
            turing = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 1.0
            d = (turing - common) / (1 - common) if common < 1 else 1.0
            keep.append(d if 0.05 <= d <= 0.95 or not np.isfinite(d) else min(0.95, max(0.05, d)))
        return cls(tuple(keep))

    @property
    def lost(self) -> float:
        """What counts over K lose."""
        return K * (1 - self.keep[-1])

    def of_counts(self, c: np.ndarray) -> np.ndarray:
        small = np.array([0.0, *(r * d for r, d in enumerate(self.keep, 1))])
        return np.where(c <= K, small[np.minimum(c, K).astype(np.int64)], c - self.lost)

    def of_sums(self, sums: np.ndarray) -> np.ndarray:
        """Discounted total of rows of (followers seen 1..K times, more often, and the total of these)."""
        out = sums[:, K + 1] - self.lost * sums[:, K]
        for r, d in enumerate(self.keep, 1):
            out = out + r * d * sums[:, r - 1]
        return out


@dataclass(frozen=True)
class Unigrams:
    total: int
    distinct: int
    discounts: Discounts
    unseen: float  # probability of one unseen word

    @classmethod
    def of(cls, total: int, distinct: int, big: int, big_sum: int, times: np.ndarray) -> Unigrams:
        d = Discounts.of(times)
        seen = float(d.of_sums(np.array([[*times[:K], big, big_sum]], float))[0])
        classes = max(1.0, times[0] ** 2 / (2 * max(times[1], 1)))
        return cls(total, distinct, d, (1 - seen / total if total else 1.0) / classes)

    def of_counts(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounts.of_counts(c) / max(self.total, 1), self.unseen)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> bytes:
    """The tokens of a block: how many each text has, the distinct words, the most frequent first (the end as an empty one), and the number of each token among these."""
    data, n = _LOWER[data], len(offsets) - 1
    start, end = words_of(data)
    sizes = np.bincount(np.searchsorted(offsets, start, "right") - 1, minlength=n) + 1
    ends = np.cumsum(sizes) - 1
    token = np.full(int(sizes.sum()), END, np.uint64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = span_hashes(data, start, end)
    words, local, counts = np.unique(token, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    local = place[local]
    stands = np.full(len(words), -1, np.int64)  # a place of each word in the buffer; the end has none
    stands[local[inner]] = np.arange(len(start))
    some = stands >= 0
    size = np.zeros(len(words), np.int64)
    size[some] = (end - start)[stands[some]]
    at = np.repeat(start[stands[some]] - np.cumsum(size[some]) + size[some], size[some]) + np.arange(int(size.sum()))
    return squeeze(sizes, size, data[at], local)


class Tokens:
    """The tokens of a block: their hashes, documents, and local word numbers in the order in which buckets are asked."""

    def __init__(self, row: dict, buckets: int) -> None:
        sizes, size, text, local = unsqueeze(row["texts"])
        n, stop = len(sizes), np.cumsum(size.astype(np.int64))
        words = np.where(size == 0, END, span_hashes(text, stop - size.astype(np.int64), stop))
        self.ids = np.frombuffer(row["ids"], np.int64, n)
        self.held = np.array([zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in self.ids.tolist()], bool) & ~nulls(row)
        self.doc = np.repeat(np.arange(n), sizes.astype(np.int64))
        self.train = ~self.held[self.doc]
        order = np.argsort(words)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.words, self.local = words[order], place[local.astype(np.int64)]
        self.bucket = route(self.words, buckets)
        self.counts = np.bincount(self.local[self.train], minlength=len(order))
        self.first = np.cumsum(sizes.astype(np.int64)) - sizes.astype(np.int64)


def _distinct(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For keys under `most`: one place of each distinct key, in order, and the number of each key among them."""
    n = len(key)
    bits = max(1, n.bit_length())
    if most.bit_length() + bits > 64:
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        return first, back
    both = np.sort(key.astype(np.uint64) << np.uint64(bits) | np.arange(n, dtype=np.uint64))
    order = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    both >>= np.uint64(bits)
    new = first_of_runs(both)
    back = np.empty(n, np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


@dataclass
class Level:
    """The distinct n-grams of one length in a block, in the order in which buckets are asked."""

    of_token: np.ndarray  # -1 where a text has too few words before
    context: np.ndarray  # a place in contexts
    word: np.ndarray
    word_id: np.ndarray
    suffix: np.ndarray  # the same without its first word, of the level below
    counts: np.ndarray  # of training tokens in the block
    bucket: np.ndarray  # the count of buckets where the context is the block's own
    contexts: np.ndarray  # names
    followed: np.ndarray  # how often training tokens follow each context
    below: np.ndarray  # and how often they follow it without its first word
    hot: np.ndarray
    total: np.ndarray | None = None  # in all blocks, once these are known
    alone: np.ndarray | None = None  # whether no other block holds the n-gram

    def names(self) -> np.ndarray:
        """Of the n-grams as contexts of longer ones; words have their ids."""
        return mix(mix(self.contexts[self.context]) + self.word_id) if len(self.contexts) else self.word_id


def _words_level(t: Tokens, ids: np.ndarray, totals: np.ndarray, alone: np.ndarray) -> Level:
    none = np.zeros(len(ids), np.int64)
    return Level(t.local, none, np.arange(len(ids)), ids, none, t.counts, t.bucket, none[:0].view(np.uint64), none, none, none, totals.astype(np.int64), alone)


def _next_level(t: Tokens, levels: list[Level], hot: int, buckets: int, starts: int, total: int) -> Level:
    """The n-grams that are one word longer than those of the last level. starts: training texts; total: training tokens."""
    words, low = levels[0], levels[-1]
    context = np.empty_like(t.local)
    context[1:] = low.of_token[:-1]
    if len(levels) == 1:  # the start of a text is one more context
        names, followed, alone, below = np.append(words.word_id, START), np.append(low.total, starts), np.append(low.alone, False), np.full(len(words.word_id) + 1, total)
        context[t.first] = len(words.word_id)
        is_hot = np.append(low.total >= hot, True)
        home = route(mix(names), buckets)
    else:
        names, followed, alone, below = low.names(), low.total, low.alone, levels[-2].total[low.suffix]
        context[t.first] = -1
        is_hot = followed >= hot
        home = route(names, buckets)
    own = alone & ~is_hot
    home[own] = buckets
    shared = np.flatnonzero(~own)
    by_name = shared[np.lexsort((names[shared], home[shared])) if len(levels) == 1 else np.argsort(names[shared])]  # hashes ascend with their buckets
    rank = np.empty(len(names), np.int64)
    rank[by_name], rank[own] = np.arange(len(shared)), np.arange(len(shared), len(names))
    by_id = np.empty(len(words.word_id), np.int64)
    by_id[np.argsort(words.word_id)] = np.arange(len(words.word_id))
    has = np.flatnonzero(context >= 0)
    first, back = _distinct(rank[context[has]] * len(by_id) + by_id[t.local[has]], len(names) * len(by_id) + 1)
    at = has[first]
    a = context[at]
    bucket = home[a]
    dealt = np.flatnonzero(is_hot[a])
    if len(dealt):
        bucket[dealt] = route(mix(mix(names[a[dealt]]) + words.word_id[t.local[at[dealt]]]), buckets)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        at, a, bucket, back = at[order], a[order], bucket[order], place[back]
    of_token = np.full(len(t.local), -1, np.int64)
    of_token[has] = back
    counts = np.bincount(back[t.train[has]], minlength=len(at))
    b = t.local[at]
    return Level(of_token, a, b, words.word_id[b], low.of_token[at], counts, bucket, names, followed, below, is_hot)


def _runs(context: np.ndarray) -> np.ndarray:
    """Where a new context begins."""
    return np.flatnonzero(first_of_runs(context))


def _words(buckets: int):
    def run(row):
        t = Tokens(row, buckets)
        for k, part in split(t.bucket, buckets):
            yield k, squeeze(t.words[part], t.counts[part])

    return run


def _times(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1..K + 1, over K, and the total of those, of all, and how many are not 0."""
    small = np.bincount(counts[counts <= K + 1].astype(np.int64), minlength=K + 2)[1:]
    return np.array([*small, (counts > K).sum(), counts[counts > K].sum(), counts.sum(), (counts > 0).sum()], np.uint64)


def _sums(of: np.ndarray, n: int, totals: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each of n contexts, over its followers seen in training: how many values are 1..K, how many larger, and the total of these."""
    of, values = of[totals > 0], values[totals > 0]
    out = np.zeros((n, K + 2), np.int64)
    for r in range(1, K + 1):
        out[:, r - 1] = np.bincount(of[values == r], minlength=n)
    out[:, K] = np.bincount(of[values > K], minlength=n)
    out[:, K + 1] = np.bincount(of[values > K], values[values > K].astype(float), n)
    return out


def _number(buckets: int):
    def run(bucket, asked):
        words, back, blocks = np.unique(np.concatenate([a[0] for _, a in asked]), return_inverse=True, return_counts=True)
        totals = np.bincount(back, np.concatenate([a[1] for _, a in asked]).astype(float), len(words)).astype(np.uint64)
        rank = np.empty(len(words), np.uint64)
        rank[np.argsort(-totals.astype(np.int64), kind="stable")] = np.arange(len(words), dtype=np.uint64)
        ids = rank * np.uint64(buckets) + np.uint64(bucket + 1)
        says = totals << np.uint64(1) | (blocks == 1).astype(np.uint64)
        at = 0
        for block, a in asked:
            mine = back[at : at + len(a[0])]
            at += len(a[0])
            yield block, squeeze(ids[mine], says[mine])
        yield -1, squeeze(_times(totals))

    return run


@dataclass(frozen=True)
class Known:
    """What is known of the whole corpus so far: starts is 0 until the bigrams are counted."""

    unigrams: Unigrams
    hot: int
    buckets: int
    starts: int = 0


def _levels(row, got, known: Known, n: int) -> tuple[Tokens, list[Level]]:
    """The levels 1..n of a block; the answers for all but the last are in got, under (level - 1) * buckets + bucket."""
    buckets = known.buckets
    t = Tokens(row, buckets)
    parts = [got[k][0] for k, _ in split(t.bucket, buckets)]
    ids, says = (np.concatenate([np.zeros(0, np.uint64), *(p[i] for p in parts)]) for i in (0, 1))
    levels = [_words_level(t, ids, says >> np.uint64(1), says & np.uint64(1) > 0)]
    for k in range(2, n + 1):
        levels.append(_next_level(t, levels, known.hot, buckets, known.starts, known.unigrams.total))
        if k < n:
            _told(levels[-1], got, buckets, k)
    return t, levels


def _told(level: Level, got, buckets: int, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sets a level's totals from the answers; gives (contexts, sums of counts, sums of shorter counts) where a backoff weight may be needed."""
    level.total, level.alone = np.zeros(len(level.word), np.int64), np.ones(len(level.word), bool)
    out = []
    for k, part in split(level.bucket, buckets):
        says, need, *sums = got[k + (n - 1) * buckets][0]
        level.total[part] = says >> np.uint64(1)
        level.alone[part] = says & np.uint64(1) > 0
        if len(need):
            a = level.context[part]
            both = np.stack([x.astype(np.int64) for x in sums], 1)
            out.append((a[_runs(a)][need.astype(np.int64)], both[:, : K + 2], both[:, K + 2 :]))
    own = level.bucket == buckets
    level.total[own] = level.counts[own]
    return out


def _ask(known: Known, n: int):
    """Sends the n-grams of a block, but for those of contexts of its own, of which a summary goes to one bucket."""

    def run(row, got):
        out = []
        if row is not None:
            t, levels = _levels(row, got, known, n)
            g, low = levels[-1], levels[-2]
            shorter = np.where(g.counts > 0, low.total[g.suffix], 0)
            for k, part in split(g.bucket, known.buckets):
                heads = _runs(g.context[part])
                a = g.context[part][heads]
                out.append((k, squeeze(np.diff(g.contexts[a], prepend=np.uint64(0)), np.diff(heads, append=part.stop - part.start), g.word_id[part], g.counts[part], shorter[part], g.hot[a])))
            own = g.counts[g.bucket == known.buckets]
            out.append((int(row["block"]) % known.buckets, squeeze(_times(own))))
        b, p = zip(*out, strict=True) if out else ((), ())
        return pa.table({"bucket": pa.array(b, pa.int64()), "block": pa.array([row["block"]] * len(b) if b else [], pa.int64()), "payload": pa.array(p, pa.binary())})

    return run


def _count(bucket, every):
    """Counts the followers of the bucket's contexts; answers each block for its n-grams, with the sums of contexts that it has unseen followers of."""
    asked = [(block, x) for block, x in every if len(x) > 1]
    times = np.sum([x[0] for _, x in every if len(x) == 1] or [np.zeros(K + 5, np.uint64)], axis=0)
    if not asked:
        yield -1, squeeze(times, *[np.zeros(0, np.uint64)] * (2 * K + 5))
        return
    names = [np.cumsum(x[0]) for _, x in asked]
    b, counts, shorter = (np.concatenate([x[i] for _, x in asked]) for i in (2, 3, 4))
    context, of = np.unique(np.concatenate(names), return_inverse=True)
    of = np.repeat(of, np.concatenate([x[1] for _, x in asked]).astype(np.int64)).astype(np.uint64)
    wide = np.uint64(int(b.max(initial=0)).bit_length())
    key = of << wide | b if len(context).bit_length() + int(wide) <= 64 else np.unique(np.stack((of, b)), axis=1, return_inverse=True)[1].ravel()
    order = np.argsort(key)
    new = first_of_runs(key[order])
    heads = np.flatnonzero(new)
    of = of[order][heads].astype(np.int64)
    totals = np.add.reduceat(counts[order], heads).astype(np.int64)
    values = np.maximum.reduceat(shorter[order], heads).astype(np.int64)
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    says = totals.astype(np.uint64) << np.uint64(1) | (np.diff(heads, append=len(order)) == 1).astype(np.uint64)
    sums = np.concatenate((_sums(of, len(context), totals, totals), _sums(of, len(context), totals, values)), 1)
    is_hot = np.zeros(len(context), bool)
    at = 0
    for mine, (block, x) in zip(names, asked, strict=True):
        n = len(x[2])
        total = says[back[at : at + n]]
        at += n
        where = np.searchsorted(context, mine)
        is_hot[where] |= x[5] > 0
        first = np.cumsum(x[1].astype(np.int64)) - x[1].astype(np.int64)
        need = np.flatnonzero((np.add.reduceat(total < 2, first, dtype=np.int64) > 0) & (x[5] == 0))
        yield block, squeeze(total, need, *sums[where[need]].T)
    hot = np.flatnonzero(is_hot)
    yield -1, squeeze(times + _times(totals), context[hot], *sums[hot].T)


def _score(known: Known, discounts: list[Discounts], hot_sums):
    """discounts: of levels 1.., hot_sums: a broadcast of, for each level from 2 on, context -> sums."""

    def run(row, got):
        if row is None:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], [x.split()[0] for x in SCHEMA.split(", ")])
        unigrams = known.unigrams
        t, levels = _levels(row, got, known, len(discounts))
        totals = levels[0].total
        p = unigrams.of_counts(totals)
        of_text = p[t.local]
        for n, g in enumerate(levels[1:], 2):
            weight = np.ones(len(g.contexts))

            def backoff(where: np.ndarray, sums: np.ndarray, shorter: np.ndarray, g=g, n=n, weight=weight) -> None:
                lost = 1 - discounts[n - 1].of_sums(sums) / np.maximum(g.followed[where], 1)
                weight[where] = lost / np.maximum(1 - discounts[n - 2].of_sums(shorter) / np.maximum(g.below[where], 1), 1e-12)

            for part in _told(g, got, known.buckets, n):
                backoff(*part)
            own = np.flatnonzero(g.bucket == known.buckets)
            if len(own):
                where, of = np.unique(g.context[own], return_inverse=True)
                shorter = levels[n - 2].total[g.suffix[own]]
                backoff(where, _sums(of, len(where), g.total[own], g.total[own]), _sums(of, len(where), g.total[own], shorter))
            here = [k for k in np.flatnonzero(g.hot).tolist() if int(g.contexts[k]) in hot_sums.value[n]]
            if here:
                found = np.stack([hot_sums.value[n][int(g.contexts[k])] for k in here])
                backoff(np.array(here), found[:, : K + 2], found[:, K + 2 :])
            weight[g.followed == 0] = 1.0
            p = np.where(g.total > 0, discounts[n - 1].of_counts(g.total) / np.maximum(g.followed[g.context], 1), weight[g.context] * p[g.suffix])
            has = g.of_token >= 0
            of_text[has] = p[g.of_token[has]]
        n = len(t.ids)
        base = np.log10((totals + 0.5) / (unigrams.total + 0.5 * (unigrams.distinct + 1)))
        return pa.table(
            {
                "doc_id": id_column(row),
                "held_out": pa.array(t.held),
                "n_tokens": pa.array(np.bincount(t.doc, minlength=n)),
                "n_known": pa.array(np.bincount(t.doc[totals[t.local] > 0], minlength=n)),
                "train_tokens": pa.array(np.full(n, unigrams.total, np.int64)),
                "base_score": pa.array(np.bincount(t.doc, base[t.local], n)),
                "score": pa.array(np.bincount(t.doc, np.log10(np.maximum(of_text, 1e-300)), n)),
            }
        )

    return run


def _summaries(answers: DataFrame) -> DataFrame:
    return answers.where("block = -1")


def _totals(answers: DataFrame) -> np.ndarray:
    """Sum of the first array of every bucket's summary, added where the buckets are."""

    def over(batches):
        for batch in batches:
            for row in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([unsqueeze(row)[0].astype(np.int64).tolist()], pa.list_(pa.int64()))], ["v"])

    rows = _summaries(answers).select("payload").mapInArrow(over, "v array<long>")
    n = K + 5
    got = rows.agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(n)]).first()
    return np.array([x or 0 for x in got], np.int64)


def _hot_sums(answers: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the hot contexts over all buckets, by name."""
    columns = ["a", *(f"s{i}" for i in range(2 * K + 4))]

    def over(batches):
        for batch in batches:
            for row in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in unsqueeze(row)[1:]], columns)

    rows = _summaries(answers).select("payload").mapInArrow(over, ", ".join(f"{c} long" for c in columns))
    return {r[0] % (1 << 64): np.array(r[1:], np.int64) for r in rows.groupBy("a").agg(*[F.sum(c) for c in columns[1:]]).collect()}


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Token counts, the smoothed-unigram base score and the model's log10 probability of each text. order: words of the longest n-gram, 2 or more."""
    if order < 2:
        raise ValueError("a model that backs off needs order 2 or more")
    blocks = make_blocks(docs, id_col, text_col, scale=1.6, pack=tokens_of)  # larger blocks repeat fewer words and n-grams
    buckets = bucket_count(blocks)
    spark = docs.sparkSession
    words = answer(spark, lambda: send(blocks, _words(buckets)), buckets, _number(buckets))
    *times, big, big_sum, total, distinct = _totals(words).tolist()
    unigrams = Unigrams.of(total, distinct, big, big_sum, np.array(times))
    known = Known(unigrams, max(HOT, total // MOST_HOT), buckets)
    answers = words.where("block >= 0")
    discounts, hot_sums = [unigrams.discounts], {}
    for n in range(2, order + 1):
        counted = answer(spark, lambda n=n, answers=answers, known=known: rejoin(blocks, answers, _ask(known, n), SENT), buckets, _count)
        discounts.append(Discounts.of(_totals(counted)[: K + 1]))
        hot_sums[n] = _hot_sums(counted)
        if n == 2 and (begun := hot_sums[2].get(int(START))) is not None:
            known = Known(unigrams, known.hot, buckets, int(begun[:K] @ np.arange(1, K + 1) + begun[K + 1]))
        answers = answers.unionByName(counted.where("block >= 0").withColumn("bucket", F.col("bucket") + (n - 1) * buckets))
    return rejoin(blocks, answers, _score(known, discounts, spark.sparkContext.broadcast(hot_sums)), SCHEMA)
