import random
import re
from collections import Counter, defaultdict

import pytest

from lodestone.llm import phrases
from lodestone.llm.phrases import collocations

from .util import frame, sample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most=5, least=100, share=100, best=2000):
    """rows: (text, lang)."""
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, most + 1):
                for k in range(len(w) - n + 1):
                    f["und" if lang is None else lang][tuple(w[k : k + n])] += 1
    out = []
    for lang, c in f.items():
        total = sum(v for p, v in c.items() if len(p) == 1)
        held = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        dropped = {p[i:j] for p, a in held.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= share * c[p[i:j]]}
        found = []
        for p, a in held.items():
            if p not in dropped:
                score, _, l, r = min((1000 * a * total // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, n, p.decode(), -a, l, r, total, -s) for n, (s, a, p, l, r) in enumerate(sorted(found)[:best], 1)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, collocations(docs, **options).collect()))


def rows_of(docs):
    return [(r.text, r.lang) for r in docs.select("text", "lang").collect()]


def test_sample_equals_brute_force(spark):
    docs = sample(spark)
    want = brute(rows_of(docs), least=20)
    assert len(want) > 20
    assert found(docs, least=20) == want


@pytest.mark.parametrize("seed", range(3))
def test_few_words_and_all_lengths(spark, seed):
    """Overlaps, ties in score and count, contained phrases; a full filter, which lets all pairs through, changes nothing."""
    r = random.Random(seed)
    vocabulary = ["a", "B", "é", "É", "c-d", "x'", "你"][: 3 + 2 * seed]
    parts = [" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b", "?"]
    rows = []
    for k in range(120):
        w = [r.choice(vocabulary) if r.random() < 0.5 else "a B é a" for _ in range(r.randint(0, 30))]
        rows.append((k, "".join(x + r.choice(parts) for x in w), r.choice(["en", "en", "und", None, "de"])))
    rows += rows[:7] + [(None, None, None), (None, "a B a B", None), (1, " .. ", "zz")]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, lang string, phrase string, n long").repartition(3)
    for share, best in ((100, 2000), (60, 5)):
        want = brute([(t, lang) for _, t, lang in rows], least=4, share=share, best=best)
        assert want
        with pytest.MonkeyPatch.context() as m:
            m.setattr(phrases, "BLOCK", 500)
            m.setattr(phrases, "FILTER", 1 << (16 + seed))
            m.setattr(phrases, "SEGMENT", 10)
            assert found(docs, least=4, share=share, best=best) == want


def test_awkward_rows(spark):
    docs = frame(spark)
    assert found(docs, least=2) == brute(rows_of(docs), least=2)


def test_empty_table_and_nothing_frequent(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark).limit(4), least=10**6) == []


def test_products_beyond_64_bits(spark):
    """The exact quotient where doubles and 64-bit products fail."""
    from pyspark.sql import functions as F

    a, n, l, r = 10**12 - 1, 10**13 + 7, 10**12 + 39, 10**12 + 61
    got = spark.range(1).select(F.expr(f"(1000bd * cast({a}L as decimal(17, 0)) * cast({n}L as decimal(17, 0))) div (cast({l}L as decimal(19, 0)) * cast({r}L as decimal(19, 0)))")).first()[0]
    assert got == 1000 * a * n // (l * r)
