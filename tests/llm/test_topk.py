import random

import numpy as np

from lodestone.llm.topk import SortedLists, top_k


def brute(rows, every, k):
    import math

    def q(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(64 * x) for x in v]

    data = [(i, q(v)) for i, v in rows if q(v) is not None]
    out = []
    for i, a in {i: a for i, a in sorted(data, reverse=True)}.items():
        if i % every == 0:
            best = sorted((-min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), j) for j, b in data if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, every=3, k=7):
    df = spark.createDataFrame([(i, v, 1.5) for i, v in rows], "vec_id long, embedding array<float>, score double")
    return sorted(map(tuple, top_k(df, df.where(df.vec_id % every == 0), k).collect()))


def test_agrees_with_brute_force(spark, monkeypatch):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, -0.5, 0.0, 0.25, 0.7]) for _ in range(6)]) for i in range(300)]
    rows += [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(300, 900)]
    rows += [(900, None), (903, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (906, [float("nan")] * 6), (909, [float("inf")] * 6), (912, [0.0] * 6), (915, [1e12] * 6), (916, [1e12] * 6)]
    monkeypatch.setattr("lodestone.llm.topk.ROWS", 250)
    monkeypatch.setattr("lodestone.llm.topk.QUERIES", 100)
    rows = [(i, v and [None if x is None else float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows, 3, 7)


def test_few_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (0, [1.0]), (1, [0.5]), (1, [0.5])]) == [(0, 1, 1, 2048), (0, 2, 1, 2048)]


def test_null_ids_and_clashing_columns(spark):
    """Rows of null id take no part; further columns, also those named as the operator's own, are not read."""
    rows = [(0, [1.0]), (None, [9.0]), (1, [0.5]), (2, [0.25])]
    df = spark.createDataFrame([(i, v, "x", -1, "y", 0, "z") for i, v in rows], "vec_id long, embedding array<float>, id string, rank int, query_id string, q int, v string")
    got = sorted(map(tuple, top_k(df, df.where("vec_id is null or vec_id = 0"), 5).collect()))
    assert got == [(0, 1, 1, 2048), (0, 2, 2, 1024)]


def test_rows_met_are_counted_before_the_cut():
    r = np.random.default_rng(1)
    flat = r.integers(-64, 64, (400, 32))
    steep = np.vstack([np.eye(2, dtype=np.int64)[[0] * 20 + [1] * 380] * 1000 + r.integers(0, 9, (400, 2))])
    for rows, fewest, most in ((flat, 399, 399), (steep, 20, 200)):
        lists = SortedLists(np.arange(400), rows, np.float64)
        met = lists.top(0, rows[0].astype(float), 10)[2]
        assert fewest <= met <= most
