import random

import numpy as np
import pytest
import xxhash

from lodestone.llm.simhash import RADIUS, balls, fingerprint, forest, near_duplicate_digest, near_duplicates

from .util import WORD, frame, pairs, sample


def brute_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= RADIUS:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("source", [frame, sample])
def test_agrees_with_brute_force(spark, source):
    df = source(spark)
    prints = {i: brute_print(t) for i, t in pairs(df)}
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicate_digest(df).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_every_link_meets():
    r = random.Random(4)
    for _ in range(3000):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), r.randint(0, 4)):
            y ^= 1 << b
        met = False
        for (_, v, _), (_, w, _) in zip(balls(np.array([x], np.uint64)), balls(np.array([y], np.uint64)), strict=True):
            met |= bool(np.intersect1d(v, w).size)
        assert met


def test_forest_joins_chains():
    fps = np.array([0, 0b1111, 0b11111111, 1 << 40, 0xFFFF << 48], np.uint64)
    assert len(forest(fps)) == 3
    assert fingerprint("") == 0


def test_empty(spark):
    assert near_duplicate_digest(frame(spark, [])).count() == 0


def test_repeated_and_null_ids(spark):
    near = " ".join(f"w{i}" for i in range(200))
    rows = [(7, near), (7, "quite another text than that one"), (None, near + " x"), (9, near), (None, "a text alone of null id"), (-4, "quite another text than that one")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    near_id = brute_print(near)
    for r in got:
        want = brute_print(next(t for i, t in rows if i == r.doc_id and brute_print(t) == r.fp % (1 << 64)))
        assert r.component_id == (None if want == brute_print(rows[4][1]) else -4 if want == brute_print(rows[1][1]) else 7)
    assert (near_id ^ brute_print(near + " x")).bit_count() <= 4


def test_chains_are_named_by_the_smallest_value(spark):
    from lodestone.llm.graph import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    values = spark.createDataFrame([(i, None if i == 3 else 1000 - i % 7) for i in range(60)] + [(100, None), (101, None)], "node long, value long")
    got = {r.node: r.value for r in components(edges, values).collect()}
    assert got == {i: 994 for i in range(51)} | {100: None, 101: None}
