from collections import Counter

import pytest

from lodestone.llm.quality_rules import LIMITS, repetition_quality

from .util import WORD, frame, pairs, sample


def brute(text):
    words = WORD.findall(text)
    n = len(words)
    chars = sum(map(len, words))

    def inside(k):
        grams = [tuple(words[i : i + k]) for i in range(n - k + 1)]
        seen = Counter(grams)
        return {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(k)}

    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup, dup_chars = set(), 0, 0
    for x in lines:
        dup += x in seen
        dup_chars += (x in seen) * sum(map(len, WORD.findall(x)))
        seen.add(x)
    shares = [sum(len(words[i]) for i in inside(k)) / max(chars, 1) for k in LIMITS]
    failed = n < 10 or 100 * len(inside(5)) > 20 * n
    kept = not failed and dup_chars / max(chars, 1) <= 0.3 and all(s <= m for s, m in zip(shares, LIMITS.values()))
    return n, chars, sum(c in "#*$%&|<>" for c in text), dup, len(inside(5)), failed, kept, dup_chars / max(chars, 1), *shares


@pytest.mark.parametrize("source", [frame, sample])
def test_agrees_with_brute_force(spark, source):
    df = source(spark)
    got = {r.doc_id: r for r in repetition_quality(df).collect()}
    assert len(got) == df.count()
    for i, t in pairs(df):
        assert tuple(got[i])[1:] == pytest.approx(brute(t)), i


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096, 8192])
def test_texts_that_rolling_hashes_confuse(spark, n):
    words = [thue_morse(n), thue_morse(n, "b", "a")]
    texts = ["\n".join([*words, words[0]]), " ".join(words * 6), " ".join([*words, *"cdefgh"]) + "\n" + " ".join([words[1], words[0], *"cdefgh"])]
    got = {r.doc_id: tuple(r)[1:] for r in repetition_quality(frame(spark, [(i, t, None, None, None, None, None) for i, t in enumerate(texts)])).collect()}
    assert all(got[i] == pytest.approx(brute(t)) for i, t in enumerate(texts)) and got[0][3] == 1


def test_span_hashes():
    import random

    import numpy as np

    from lodestone.llm.common import span_hashes

    r = random.Random(1)
    data = np.frombuffer(bytes(r.choice(b"ab\0") for _ in range(3000)), np.uint8)
    spans = [(a, a + r.choice([0, 1, 7, 8, 9, 16, 17, 63, 64, 65, 200])) for a in (r.randrange(2800) for _ in range(4000))]
    spans += [(2993, 3000), (3000, 3000)]
    got = span_hashes(data, *(np.array(x) for x in zip(*spans, strict=True))).tolist()
    texts = [data[a:b].tobytes() for a, b in spans]
    assert len(set(zip(texts, got, strict=True))) == len(set(texts)) == len(set(got))


def test_null_ids_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "a b c", 1, True), (3, None, 2, False), (None, None, 3, True)], "doc_id long, text string, n_words int, kept boolean")
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words) for r in repetition_quality(df).collect()) == [(False, 3, 0), (True, 0, 0), (True, 0, 3)]


def test_empty_and_repeated_rows(spark):
    assert repetition_quality(frame(spark, [])).count() == 0
    twice = frame(spark).union(frame(spark))
    assert repetition_quality(twice).count() == twice.count()
