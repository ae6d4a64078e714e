"""Queries that must do the whole job, against brute force or SQL of their own: copies, all queries, all permutations."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.operators import dedup
from lodestone.plans import catalog

from .conftest import SF


def _words(text):
    return [w for w in text.lower().split() if w]


def _shingles(text):
    w = _words(text)
    return frozenset([" ".join(w[i : i + 3]) for i in range(len(w) - 2)] + (w if len(w) < 10 else [])) if len(w) >= 3 else None


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Documents with copies of high and of low authority, a near pair between two classes of copies, and copies alone."""
    base = [f"w{i}" for i in range(60)]
    near, link, alone = [*base[:59], "z"], [*base[:56], "q", "r", "s", "t"], [f"v{i}" for i in range(20)]
    rows = [(1, base, "src1"), (2, base, "src6"), (3, near, "src2"), (4, near, "src3"), (5, near, "src2"), (6, alone, "src4"), (7, alone, "src4"), (8, link, "src0"), (9, ["only"], "src5"), (10, [f"u{i}" for i in range(15)], "src5")]
    folder = str(tmp_path_factory.mktemp("copies"))
    spark.createDataFrame([(i, " ".join(w), "en", s) for i, w, s in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return folder, {i: (_shingles(" ".join(w)), int(s[3:]) % 7 / 10) for i, w, s in rows}


def _brute(docs):
    """Links of all documents: of classes by their best member, of copies to it at 1."""
    groups = defaultdict(list)
    for i, (s, _) in docs.items():
        if s:
            groups[s].append(i)
    best = {s: min(m, key=lambda i: (-docs[i][1], i)) for s, m in groups.items()}
    links = {tuple(sorted((i, best[s]))): 1.0 for s, m in groups.items() for i in m if i != best[s]}
    for s in best:
        for t in best:
            if best[s] < best[t] and (j := len(s & t) / len(s | t)) >= 0.8:
                links[best[s], best[t]] = j
    return links


def _expected(docs):
    out = set()
    for (a, b), j in _brute(docs).items():
        keep, other = (b, a) if docs[b][1] > docs[a][1] else (a, b)
        out.add((a, b, "DROP" if j > 0.95 else "MERGE" if j > 0.9 else "LINK", keep, other))
    return out


def test_copies_have_actions(spark, copies):
    folder, docs = copies
    want = _expected(docs)
    acted = catalog.dedup_actions(spark, folder).collect()
    assert len(acted) == len(want) and {(r.a, r.b, r.action, r.keep, r.other) for r in acted} == want
    assert (1, 2, "DROP", 2, 1) in want  # the copy of higher authority is kept, though it is not the first
    stats = catalog.dedup_stats(spark, folder).first()
    assert (stats.pairs, stats.drop) == (len(want), sum(x[2] == "DROP" for x in want))


def test_copies_are_dropped_and_clustered(spark, copies):
    folder, docs = copies
    assert {x[4] for x in _expected(docs) if x[2] == "DROP"} == {1, 3, 4, 5, 7}
    assert {r.doc_id for r in catalog.apply_dedup(spark, folder).collect()} == {2, 6, 8, 9, 10}
    assert {r.members for r in catalog.dup_clusters(spark, folder).collect()} == {"1,2,3,4,5,8", "6,7"}


def test_copies_at_sf(spark):
    docs = {r.doc_id: (_shingles(r.text), int(r.source[3:]) % 7 / 10) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {(r.a, r.b, r.action, r.keep, r.other) for r in catalog.dedup_actions(spark, SF).collect()} == _expected(docs)


def test_no_authority_is_the_least(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", None), (2, "a b c", "x", 0.5), (3, "a b c", "x", None)], "id long, text string, source string, authority double")
    sets = dedup.shingle_sets(docs, "id", F.col("text"))
    acted = dedup.actions(dedup.with_sources(dedup.with_copies(dedup.jaccard_pairs(sets, 0.8), dedup.classes(sets), docs), docs))
    assert [r.id for r in dedup.apply_actions(docs, acted).collect()] == [2]


@pytest.mark.parametrize("name", ["dense_topk", "hybrid_search", "rrf_single_list"])
def test_every_fiftieth_row_asks_with_its_whole_text(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = {x[:2]: x[2:] for x in con.execute(f"SELECT query_id, rank, id, score FROM ({catalog.SQL[name]})").fetchall()}
    rows = catalog.QUERIES[name](spark, SF).collect()
    got = {(r.query_id, r.rank): (r.id, r.score) for r in rows}
    ids = con.execute("SELECT vec_id FROM embeddings WHERE vec_id % 50 = 0").fetchall()
    assert len(rows) == len(got) and {q for q, _ in got} == {i for (i,) in ids}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-8) for k in got)


@pytest.fixture(scope="module")
def nearby(spark, tmp_path_factory):
    """Sets of one text with one word changed, which few permutations tell apart; copies; sets near 0.8 on both sides."""
    base = [f"w{i}" for i in range(300)]
    texts = [base] + [base[:i] + ["x"] + base[i + 1 :] for i in range(20, 280, 20)] + [base, base[:20] + ["x"] + base[21:]]
    texts += [[f"{k}_{i}" for i in range(200)] for k in range(5)] + [[f"{k}_{i}" for i in range(n)] for k, n in enumerate([170, 162, 160, 158, 150])]
    folder = str(tmp_path_factory.mktemp("nearby"))
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return folder, {i: _shingles(t) for i, t in rows}


def test_signatures_have_128_permutations(spark, nearby):
    folder, sets = nearby
    got = {r.id: [int(x) for x in r.signature.split(",")] for r in catalog.minhash_signature(spark, folder).collect()}
    hashes = {i: [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % dedup.PRIME for g in s] for i, s in sets.items()}
    assert got == {i: [min((a * h + b) % dedup.PRIME for h in hs) for a, b in dedup.permutations(128)] for i, hs in hashes.items()}


def test_minhash_pairs_are_exact_and_reach_all(spark, nearby):
    folder, sets = nearby
    first = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    want = {(first[i], i): 1.0 for i in sets if first[i] != i}
    own = sorted(set(first.values()))
    want |= {(i, j): s for i in own for j in own if i < j and (s := len(sets[i] & sets[j]) / len(sets[i] | sets[j])) >= 0.8}
    rows = catalog.minhash_pairs(spark, folder).collect()
    assert len(rows) == len(want) > 90 and {(r.a, r.b): r.similarity for r in rows} == pytest.approx(want, abs=1e-6)
    assert {(r.a, r.b) for r in catalog.lsh_candidates(spark, folder).collect()} >= want.keys()


def test_minhash_pairs_at_sf_are_those_of_all_pairs(spark):
    sets = catalog._sets(spark, SF)
    want = {(r.a, r.b): r.similarity for r in dedup.jaccard_pairs(sets, 0.8).collect()} | {(r.a, r.b): 1.0 for r in dedup.copy_links(dedup.classes(sets)).collect()}
    assert {(r.a, r.b): r.similarity for r in catalog.minhash_pairs(spark, SF).collect()} == pytest.approx(want, abs=1e-6)
