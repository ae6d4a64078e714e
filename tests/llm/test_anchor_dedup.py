import hashlib
import random

import pytest

from lodestone.llm import anchor_dedup, blocks
from lodestone.llm.anchor_dedup import WINDOW, remove_passages

from .util import WORD, frame, sample


def brute(rows):
    """(doc_id, text) rows; a null id counts as the largest."""
    order = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - WINDOW + 1):
            key = tuple(w[k : k + WINDOW])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if first[tuple(w[k : k + WINDOW])] < order(i):
                gone.update(range(k, k + WINDOW))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **options):
    return sorted((tuple(r)[:4] for r in remove_passages(docs, **options).collect()), key=repr)


def test_sample_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in sample(spark).select("doc_id", "text").collect()]
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert found(sample(spark)) == want


def test_awkward_rows_and_clashing_columns(spark):
    docs = frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_hostile_texts(spark, seed):
    """Few words, so that grams are periodic and contested; ids of both signs, repeated and null; small blocks."""
    r = random.Random(seed)
    vocabulary = ["a", "b", "ab", "é", "a b"][: 2 + seed]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(5, 40))] for _ in range(6)]
    rows = []
    for _ in range(60):
        w = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            lo = r.randint(0, len(p) - 1)
            w += p[lo : lo + r.randint(1, 40)] + [f"u{r.random()}"] * r.randint(0, 1)
        rows.append((r.choice([None, -(2**63), 2**63 - 1, *range(-5, 20)]), r.choice([" ", "\t", " \n "]).join(w)))
    rows += rows[:5] + [(3, None), (None, None)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(blocks, "BLOCK", 600)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert found(docs) == brute(rows)


def test_texts_that_are_kept(spark):
    shared = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"x {shared}  y"), (2, f"p\n{shared} q"), (3, " ".join(shared.split()[:12]))], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in remove_passages(docs, texts=True).collect()}
    assert got == {1: f"x {shared} y", 2: "p q", 3: " ".join(shared.split()[:12])}


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_a_window_holds_a_reference_block_wherever_it_starts():
    assert WINDOW >= 2 * anchor_dedup.ANCHOR - 1
