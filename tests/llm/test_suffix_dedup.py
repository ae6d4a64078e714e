import hashlib
import random

import numpy as np
import pytest

from lodestone.llm import suffix_dedup as module
from lodestone.llm.rindex import RunIndex, suffix_ranks
from lodestone.llm.suffix_dedup import NEVER, first_documents, remove_repeats

from .util import COLUMNS, frame, pairs, sample


def brute(rows):
    first, out = {}, {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            if i < first.get(w, 1 << 62):
                first[w] = i
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def edited(spark):
    """Near copies, shared passages, runs and borders."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgé") for _ in range(r.randint(2, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (9, 12, 20, 60)]
    base = " ".join(word() for _ in range(150))
    rows = []
    for i in range(60):
        kind = i % 4
        if kind == 0:
            t = " ".join(r.choice(passages) if r.random() < 0.2 else word() for _ in range(30))
        elif kind == 1:
            k = r.randrange(len(base))
            t = base[:k] + word() + base[k + r.randint(0, 4) :]
        elif kind == 2:
            t = "ab" * r.randint(10, 80) + r.choice(passages) + "-" * r.randint(30, 120)
        else:
            k = r.randrange(len(base) - 80)
            t = word() + base[k : k + r.randint(45, 80)] + word()
        rows.append((i * 7 % 60, t, None, None, None, None, None))
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("source", [frame, edited, sample])
def test_agrees_with_brute_force(spark, source, monkeypatch):
    monkeypatch.setattr("lodestone.llm.blocks.BLOCK", 1 << 17 if source is not edited else 1 << 12)
    df = source(spark)
    want = brute(pairs(df))
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(df).collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == want[i], i


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def rows_of(rows):
    """What brute force gives for each of (id, text), ids repeated or null (as the largest)."""
    first, out = {}, []
    rows = [(MOST if i is None else i, t.encode()) for i, t in rows]
    for i, b in rows:
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(i, first.get(b[p : p + 50], MOST))
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in rows], COLUMNS)
    got = sorted((MOST if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in remove_repeats(df).collect())
    assert got == rows_of(rows)
    return got


def test_ids_of_every_sign_and_repeated_ids(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(200))
    got = check(spark, [(3, text), (-5, text), (LEAST, text[50:]), (MOST, text), (None, text + "!"), (0, "z" + text), (-5, text), (-5, text[:80] + "?" + text)])
    assert [r[2] for r in got] == [0, *[got[k][2] for k in (1, 2, 3)], 200, 200, 200, 200] and got[1][2] > 100
    ids = [r.doc_id for r in remove_repeats(spark.createDataFrame([(MOST, text, None, None, None, None, None), (None, text, None, None, None, None, None)], COLUMNS)).collect()]
    assert sorted(ids, key=str) == [MOST, None]  # the largest id stays itself


@pytest.mark.parametrize("hot", [2, 7])
def test_hot_grams_and_owners_are_split(spark, hot, monkeypatch):
    monkeypatch.setattr("lodestone.llm.blocks.BLOCK", 1 << 11)
    monkeypatch.setattr(module, "HOT_PLACES", hot)
    monkeypatch.setattr(module, "HOT_BLOCKS", hot)
    monkeypatch.setattr(module, "INDEXED", 600)
    monkeypatch.setattr(module, "OWNED", 7)
    check(spark, [(r.doc_id, r.text) for r in edited(spark).collect()])
    word, r = "the same line of a licence in each text, word by word, from its first one on to the last. ", random.Random(3)
    check(spark, [(i % 40, "".join(r.choice("abcde") for _ in range(30)) + word[: r.randint(40, 90)] + "".join(r.choice("abcde") for _ in range(30)) + word) for i in range(80)])


def test_a_gram_with_very_many_contexts():
    """100,000 contexts of one gram, of which many share windows, are indexed in bounded parts; the first documents are those of a plain scan."""
    g = np.random.default_rng(4)
    n, gram = 100_000, np.frombuffer(b"sixteen letters!", np.uint8)
    rows = np.concatenate((g.integers(97, 99, (n, 34), np.uint8), np.tile(gram, (n, 1)), g.integers(97, 99, (n, 34), np.uint8)), 1)
    rows[:, 2:24] = rows[:9, 2:24][g.integers(0, 9, n)]
    rows[:, 60:] = rows[:50, 60:][g.integers(0, 50, n)]
    owner = g.integers(0, 1 << 40, n).astype(np.uint64)
    got = first_documents(rows, owner)
    for j in range(35):
        _, back = np.unique(np.ascontiguousarray(rows[:, j : j + 50]).view("V50").ravel(), return_inverse=True)
        first = np.full(int(back.max()) + 1, NEVER, np.uint64)
        np.minimum.at(first, back, owner)
        assert (got[:, j] == first[back]).all()


@pytest.mark.parametrize("end", ["\0", "\xff"])
def test_suffixes_are_in_order_up_to_their_separator(end):
    r = random.Random(12)
    for n in [1, 2, 3, 5, 8, 40, 300, 3000]:
        text = "".join(r.choice("ab" + end if n < 50 else "abcdefghijk" * 4 + end) for _ in range(n - 1)) + end
        data = np.frombuffer(text.encode("latin-1"), np.uint8)
        order, classes = suffix_ranks(data, 20)
        head = [text[i : text.index(end, i) + 1] for i in range(n)]
        assert order.tolist() == sorted(range(n), key=lambda i: (head[i], i))
        whole = [i for i in range(n) if len(head[i]) > 20]
        assert len({classes[i] for i in whole}) == len({text[i : i + 20] for i in whole}) == len({(classes[i], text[i : i + 20]) for i in whole})


def test_separators_are_never_matched():
    text = np.frombuffer(b"abcab\xffbcabc\xffcabca\xff", np.uint8)
    lengths, places = RunIndex(text, suffix_ranks(text, 20)[0]).statistics(np.frombuffer(b"bcab\xff\xffabca\xffcab", np.uint8).reshape(1, -1))
    assert lengths[0].tolist() == [4, 3, 2, 1, 0, 0, 4, 3, 2, 1, 0, 3, 2, 1]
    assert text[places[0][0] : places[0][0] + 4].tobytes() == b"bcab"


def test_empty(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    assert remove_repeats(frame(spark, [(None, "x" * 200, None, None, None, None, None), (1, "x" * 200, None, None, None, None, None)])).where("n_removed > 0").collect()[0].doc_id is None


def test_matching_statistics():
    r = random.Random(2)
    for _ in range(20):
        text = "".join(r.choice("ab") for _ in range(r.randint(30, 200))) * 2 + "\xff"
        data = np.frombuffer(text.encode("latin-1"), np.uint8)
        order, classes = suffix_ranks(data, 20)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        assert len(set(zip(classes.tolist(), (text[i : i + 20] for i in range(len(text)))))) == len({text[i : i + 20] for i in range(len(text))})
        index = RunIndex(data, order)
        assert index.runs < len(text)
        patterns = ["".join(r.choice("abc") for _ in range(25)) for _ in range(9)]
        lengths, places = index.statistics(np.frombuffer("".join(patterns).encode(), np.uint8).reshape(9, 25))
        for p, ls, at in zip(patterns, lengths, places):
            for j in range(25):
                longest = max(n for n in range(26 - j) if p[j : j + n] in text)
                assert ls[j] == longest and (not longest or text[at[j] : at[j] + longest] == p[j : j + longest])
