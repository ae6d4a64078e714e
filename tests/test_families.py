import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import md5
from lodestone.operators import dedup
from lodestone.plans import catalog

from .conftest import SF


def components(pairs):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    return {x: find(x) for x in top}


def similar(x, y):
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def frame(spark, sets):
    return spark.createDataFrame([(k, sorted(s)) for k, s in sets.items()], "id long, set array<string>").repartition(4)


@pytest.mark.parametrize(("seed", "bucket", "rounds"), [(1, 2, 2), (2, 4, 1), (3, 64, 3), (4, 3, 0)])
def test_components_are_those_of_all_pairs(spark, seed, bucket, rounds):
    """Families around common texts, sizes that cross ranges, words that stand in most sets; brute force over all pairs."""
    r = random.Random(seed)
    hot = [f"h{k}" for k in range(12)]
    sets = {}
    for k in range(160):
        f = k % 8
        base = [f"{f}-{j}" for j in range(6 + 5 * f)] + hot[: 3 * (f % 4)]
        own = {w for w in base if r.random() > 0.04} | {f"x{k}-{j}" for j in range(r.randint(0, 2))}
        sets[k] = own or {"only"}
    all_ = [(a, b) for a in sets for b in sets if a < b and similar(sets[a], sets[b]) >= 0.8]
    members = dedup.classes(frame(spark, sets))
    links = dedup.family_links(frame(spark, sets), 0.8, members, rounds, bucket)
    got = links.collect()
    assert {(x.a, x.b) for x in got} <= set(all_) and all(abs(x.similarity - similar(sets[x.a], sets[x.b])) < 1e-9 for x in got)
    copies = [(x.a, x.b) for x in dedup.copy_links(members).collect()]
    assert len(all_) > 100 and components([(x.a, x.b) for x in got] + copies) == components(all_)


def test_a_family_of_ten_thousand_gives_about_as_many_links(spark):
    # 10,000 texts of 60 words that differ from one of them in one word each: 50 million pairs
    base = F.array(*[F.lit(f"w{k}") for k in range(60)])
    docs = spark.range(10_000, numPartitions=4).select("id", F.concat(F.slice(base, 1, 59), F.array(F.concat(F.lit("own"), F.col("id").cast("string")))).alias("set"))
    members = dedup.classes(docs)
    links = dedup.family_links(docs, 0.8, members).checkpoint()
    assert links.count() < 30_000
    assert dedup.membership(links.select("a", "b")).agg(F.count("*"), F.countDistinct("cluster")).first() == (10_000, 1)


def test_no_sets(spark):
    empty = spark.createDataFrame([], "id long, set array<string>")
    assert dedup.family_links(empty, 0.8).collect() == []


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_bands_keep_their_recall(spark, threshold):
    sets = catalog._sets(spark, "/root/testdata/sf0.01")
    members = dedup.classes(sets)
    want = {(r.a, r.b) for r in dedup.jaccard_pairs(sets, threshold, members).collect()}
    reps = sets.join(members.where("id = class").select("id"), "id", "left_semi")
    bands, rows = dedup.bands_for(threshold)
    got = {(r.a, r.b) for r in dedup.lsh_candidates(dedup.minhash(reps).checkpoint(), bands, rows).collect()}
    print(threshold, bands, rows, len(want), len(want & got), len(got))
    assert want and len(want & got) >= 0.95 * len(want)


def test_bands_are_chosen_by_what_they_miss():
    assert dedup.bands_for(0.8) == (18, 7) and dedup.bands_for(0.85) == (14, 9) and dedup.bands_for(0.99, 0.5) == (1, 68)
    assert all(dedup.missed(t, *dedup.bands_for(t, q)) <= 1 - q for t in (0.5, 0.8, 0.9) for q in (0.9, 0.99))
    with pytest.raises(ValueError, match="cannot find"):
        dedup.bands_for(0.01, 0.999)


def test_hot_classes(spark):
    """Copies that are half of all rows."""
    sets = frame(spark, {k: {"a", "b", "c"} if k % 2 else {str(k), "x", "y"} for k in range(400)})
    got = {r.id: r["class"] for r in dedup.classes(sets).collect()}
    assert got == {k: 1 if k % 2 else k for k in range(400)}


def test_hot_buckets_are_met_in_parts(spark, monkeypatch):
    """All pairs, whatever the parts."""
    monkeypatch.setattr(dedup, "MEETING", 3)
    sets = {k: {f"c{j}" for j in range(20)} | {f"o{k}"} for k in range(25)}
    got = {(r.a, r.b) for r in dedup.jaccard_pairs(frame(spark, sets), 0.8).collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b}
    signatures = spark.createDataFrame([(k, [1, 2, k % 2, k]) for k in range(25)], "id long, signature array<long>")
    assert {(r.a, r.b) for r in dedup.lsh_candidates(signatures, 2, 2).collect()} == {(a, b) for a in range(25) for b in range(25) if a < b}


def test_items_of_few_sets_are_no_meeting_place_where_sets_have_rarer_ones(spark):
    # 30 of 40 items stand in 12 sets each, the others in one: every set's first nine items are its own
    sets = {k: {f"own{k}-{j}" for j in range(10)} | {f"few{k // 12}-{j}" for j in range(30)} for k in range(240)}
    members = dedup.classes(frame(spark, sets))
    assert dedup.prefixes(members.select("id", "set"), 0.8).count() == 0
    assert dedup.jaccard_pairs(members, 0.6, members).count() == 20 * 66 and dedup.jaccard_pairs(members, 0.61, members).count() == 0


def test_hashed_sets_are_those_of_shingles(spark):
    rows = [(1, "a b c d"), (2, " A  b\tc d "), (3, "a b"), (4, None), (5, ""), (6, "a a a a a a a a a a a"), (7, "é b c d e f g h i j k"), (8, "a b c x"), (9, "b"), (10, "b c d a")]
    docs = spark.createDataFrame(rows, "k long, t string").repartition(3)
    for least in (1, 3):
        strings = {r.id: set(r.set) for r in dedup.shingle_sets(docs, "k", F.col("t"), least_words=least).collect()}
        hashes = {r.id: r.set for r in dedup.hashed_sets(docs, "k", F.col("t"), least_words=least).collect()}
        assert strings.keys() == hashes.keys() and all(sorted(set(h)) == h for h in hashes.values())
        for a in strings:
            assert [len(strings[a] & strings[b]) for b in strings] == [len(set(hashes[a]) & set(hashes[b])) for b in strings]


def test_signatures_of_texts_are_those_of_their_shingles(spark):
    """Also of long words, white space beyond ASCII, capitals, few words, and none; without a shuffle and without strings of shingles."""
    r = random.Random(3)
    parts = ["a", "Bc", "é", "😀", "x" * 60, "İ", "word"]
    gaps = [" ", "  ", "\n", "\u2003", "\u00a0", "\u3000 "]
    rows = [(i, "".join(r.choice(parts) + r.choice(gaps) for _ in range(r.randint(0, 30)))) for i in range(200)] + [(200, None), (201, ""), (202, " \u2003"), (203, "  to be or"), (204, "same " * 5000)]
    docs = spark.createDataFrame(rows, "k long, t string")
    want = {x.id: x.signature for x in dedup.minhash(dedup.shingle_sets(docs, "k", F.col("t"))).collect()}
    found = dedup.signatures(docs, "k", F.col("t"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {x.id: x.signature for x in found.collect()} == want and 150 < len(want) < 203


def test_heads_of_md5():
    data = np.frombuffer("".join(chr(i % 700 + 1) for i in range(4000)).encode(), np.uint8)
    lo = np.arange(0, 3000, 7)
    hi = lo + np.arange(len(lo)) % 150
    assert md5.heads(data, lo, hi).tolist() == [int(hashlib.md5(data[a:b].tobytes()).hexdigest()[:8], 16) for a, b in zip(lo, hi)]
    assert not len(md5.heads(data[:0], lo[:0], hi[:0]))


@pytest.mark.parametrize("name", ["jaccard_pairs", "link_counts", "dedup_stats"])
def test_whole_sets_are_written_once(spark, monkeypatch, name):
    """They were written twice and sent three times, which filled the disk."""
    kind, written = type(spark.range(1)), []
    before = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a: written.append(self.columns) or before(self, *a))
    catalog.QUERIES[name](spark, SF).collect()
    assert sum("set" in c for c in written) == 1


def test_sets_are_judged_in_turns_and_parts(spark, monkeypatch):
    monkeypatch.setattr(dedup, "JUDGED", 2)
    monkeypatch.setattr(dedup, "JUDGED_BYTES", 200)
    sets = {k: {f"c{j}" for j in range(20)} | {f"o{k}"} for k in range(12)} | {k: {f"d{k // 2}-{j}" for j in range(30)} | {f"o{k}"} for k in range(12, 30)}
    reps, members = dedup.prepared(frame(spark, sets))
    want = {(a, b): similar(sets[a], sets[b]) for a in sets for b in sets if a < b and similar(sets[a], sets[b]) >= 0.8}
    assert {(r.a, r.b): r.similarity for r in dedup.jaccard_pairs(reps, 0.8, members).collect()} == want and len(want) == 66 + 9
    pairs = spark.createDataFrame([*want, (0, 12), (3, 29)], "a long, b long")
    assert {(r.a, r.b): r.similarity for r in dedup.exact_pairs(reps, pairs, 0.8, 4).collect()} == want


def test_an_id_of_two_texts_stands_for_its_own_class_alone(spark):
    words = [f"w{j}" for j in range(30)]
    rows = [(1, words), (2, [*words, "x"]), (3, ["a", "b", "c"]), (5, [*words, "y"]), (5, ["a", "b", "c"])]
    docs = spark.createDataFrame(rows, "id long, set array<string>")
    want = {(1, 2): 30 / 31, (1, 5): 30 / 31, (2, 5): 30 / 32}
    assert {(r.a, r.b): r.similarity for r in dedup.jaccard_pairs(docs, 0.8).collect()} == want
    assert sorted((r.id, r["class"]) for r in dedup.prepared(docs)[1].collect()) == [(1, 1), (2, 2), (3, 3), (5, 3), (5, 5)]
