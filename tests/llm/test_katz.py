import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestone.llm import katz
from lodestone.llm.katz import K, Discounts, Unigrams, katz_scores

from .util import WORD, frame, pairs, sample


def tokens(t):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t)), None]


def brute(rows, order):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    uni, grams = Counter(), [defaultdict(Counter) for _ in range(order + 1)]

    def contexts(words, i, n):
        """The n - 1 words before the i-th, the start of the text among them, or None if there are fewer."""
        return ("", *words)[i + 2 - n : i + 1] if i + 2 >= n else None

    texts = [(i, [repr(w) for w in tokens(t)]) for i, t in rows]
    for i, words in texts:
        if not held[i]:
            uni.update(words)
            for at, w in enumerate(words):
                for n in range(2, order + 1):
                    if (c := contexts(words, at, n)) is not None:
                        grams[n][c][w] += 1

    def times(counts):
        c = Counter(counts)
        return np.array([c[r] for r in range(1, K + 2)])

    total = sum(uni.values())
    big = [c for c in uni.values() if c > K]
    u = Unigrams.of(total, len(uni), len(big), sum(big), times(uni.values()))
    d = [None, None, *(Discounts.of(times(c for f in g.values() for c in f.values())) for g in grams[2:])]
    disc = lambda n, c: float(d[n].of_counts(np.array([c]))[0])
    alphas = {}

    def alpha(c):
        if c not in alphas:
            n, f = len(c) + 1, grams[len(c) + 1][c]
            alphas[c] = (1 - sum(disc(n, x) for x in f.values()) / sum(f.values())) / (1 - sum(p(w, c[1:]) for w in f))
        return alphas[c]

    def p(w, c):
        n = len(c) + 1
        if n == 1:
            return float(u.of_counts(np.array([uni[w]]))[0])
        f = grams[n].get(c)
        if not f:
            return p(w, c[1:])
        return disc(n, f[w]) / sum(f.values()) if f[w] else alpha(c) * p(w, c[1:])

    classes = max(1.0, times(uni.values())[0] ** 2 / (2 * max(times(uni.values())[1], 1)))
    for n in range(2, order + 1):  # a context's probabilities sum to one, unseen words among them
        for c in [*grams[n]][:: max(1, len(grams[n]) // 6)]:
            assert sum(p(w, c) for w in uni) + classes * p("never seen", c) == pytest.approx(1)
    out = []
    for i, words in texts:
        base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (len(uni) + 1))) for w in words)
        score = sum(math.log10(p(w, contexts(words, at, min(order, at + 2)))) for at, w in enumerate(words))
        out.append((i, held[i], len(words), sum(uni[w] > 0 for w in words), total, base, score))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("source", "order", "hot"), [(frame, 2, 50_000), (frame, 3, 50_000), (frame, 3, 3), (frame, 4, 3), (sample, 2, 3), (sample, 3, 50_000), (sample, 3, 3), (sample, 4, 50_000)])
def test_agrees_with_brute_force(spark, source, order, hot, monkeypatch):
    monkeypatch.setattr(katz, "HOT", hot)
    monkeypatch.setattr("lodestone.llm.blocks.BLOCK", 1 << 18 if source is sample else 1 << 14)
    df = source(spark)
    want = brute(pairs(df), order)
    got = sorted((tuple(r) for r in katz_scores(df, order=order).collect()), key=repr)
    assert len(got) == len(want)
    for x, y in zip(got, want, strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-9), x[0]


def test_repeated_null_and_extreme_ids(spark, monkeypatch):
    monkeypatch.setattr("lodestone.llm.blocks.BLOCK", 64)
    ids = [1, 1, None, -(1 << 63), (1 << 63) - 1, 3, 7, 8, 8, None]
    rows = [(i, t) for i, t in zip(ids, ["a b c a b d", "a b c", "a b c a b c", "x y", "A B\tC", None, "", "q r s t u", "q r s", "q r"], strict=True)]
    got = sorted((tuple(r) for r in katz_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    want = brute([(i, t or "") for i, t in rows], 3)
    assert [x[:5] for x in got] == [y[:5] for y in want]
    assert all(x[5:] == pytest.approx(y[5:], rel=1e-9) for x, y in zip(got, want, strict=True))


def test_words_that_rolling_hashes_confuse(spark):
    words = ["".join("ab"[(i.bit_count() + s) % 2] for i in range(4096)) for s in (0, 1)]
    rows = [(0, words[0]), (2, words[0]), (3, "c " + words[1])]
    got = {r.doc_id: r for r in katz_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].base_score == pytest.approx(brute(rows, 3)[0][5]) and (got[3].held_out, got[3].n_known) == (True, 1)


def test_better_than_base_on_held_out_texts(spark):
    rows = [r for r in katz_scores(sample(spark)).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty(spark):
    assert katz_scores(frame(spark, [])).count() == 0
    one = katz_scores(frame(spark, [(None, None, None, None, None, None, None)])).collect()
    assert len(one) == 1 and one[0].doc_id is None and one[0].n_tokens == 1
