import random
from collections import defaultdict

import numpy as np
import pytest

from lodestone.llm import ranking

SCHEMA = "g long, h string, a long, b long, t long, u long, pos string, block string"
PAIR = (("a", True), ("b", False))


def brute(rows, most, pair=((1, True), (2, False)), ties=(3, 4)):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = []
    for g, some in groups.items():
        def last(v, down=False):
            return (v is None, 0 if v is None else -v if down else v)

        some.sort(key=lambda r: [*(last(r[k], d) for k, d in pair), *(last(r[k]) for k in ties)])
        keys = [tuple(r[k] for k, _ in pair) for r in some]
        out += [(*r, n, keys.count(k)) for n, (r, k) in enumerate(zip(some, keys), 1) if n <= most]
    return sorted(out, key=repr)


def found(spark, rows, most, **sizes):
    with pytest.MonkeyPatch.context() as m:
        for k, v in sizes.items():
            m.setattr(ranking, k, v)
        df = spark.createDataFrame([(g, "x", a, b, t, u, "clash", "clash") for g, a, b, t, u in rows], SCHEMA).repartition(5)
        out = ranking.leading_rows(df, ("g",), PAIR, ("t", "u"), most)
        assert out.columns == ["g", "a", "b", "t", "u", "pos", "tied"]
        return sorted((tuple(r) for r in out.collect()), key=repr)


def some_rows(seed, n, values=6):
    r = random.Random(seed)
    pick = lambda most: None if r.random() < 0.1 else r.randint(-most, most)
    rows = [(7 if r.random() < 0.4 else pick(30), pick(values), pick(values), pick(3), pick(1)) for _ in range(n)]
    return rows + rows[:50]  # repeated rows have places of their own


@pytest.mark.parametrize("most", [1, 2, 5])
def test_equals_brute_force(spark, most):
    rows = some_rows(most, 700)
    assert found(spark, rows, most, BLOCK=64) == brute(rows, most)


def test_many_steps_and_ranges(spark):
    rows = some_rows(9, 400, 100_000) + [(1, 2**62, -(2**63), 2**63 - 1, None), (1, -(2**62), 2**63 - 1, -(2**63), 0)]
    assert found(spark, rows, 3, BLOCK=16, FAN=2, BUCKET=100) == brute(rows, 3)


def test_all_tied_in_one_group(spark):
    rows = [(None, None, None, k % 7, None) for k in range(300)]
    got = found(spark, rows, 4, BLOCK=32)
    assert got == brute(rows, 4) and all(r[-1] == 300 for r in got)


def test_empty_and_single(spark):
    assert found(spark, [], 2) == []
    assert found(spark, [(1, None, 5, None, None)], 2) == [(1, None, 5, None, None, 1, 1)]


def test_popcounts_of_runs():
    rng = np.random.default_rng(1)
    mask = rng.random(1000) < 0.3
    cuts = np.unique(rng.integers(0, 1001, 50))
    start, end = cuts[:-1], cuts[1:]
    assert ranking.popcounts(ranking.bitmap(mask), start, end).tolist() == [int(mask[a:b].sum()) for a, b in zip(start, end)]


def test_descent_is_to_the_exact_place():
    rng = np.random.default_rng(2)
    for _ in range(200):
        count = rng.integers(0, 4, (1, 16))
        values = np.repeat(np.arange(16), count[0])
        need = int(rng.integers(1, 20))
        low, left, same = (int(x[0]) for x in ranking.descend(count, np.array([need])))
        if need <= len(values):
            assert low == values[need - 1] and left == need - (values < low).sum() and same == (values == low).sum()
        else:
            assert (values <= low).all() and same <= left
