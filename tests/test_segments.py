import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import search, segments
from lodestone.plans import catalog

VOCABULARY = ["the", "of", "alpha", "beta", "gamma", "delta", "@p", "w7", "w8", "w9"]


def texts(seed, ids):
    r = random.Random(seed)
    return {i: " ".join(r.choices(VOCABULARY, [30, 20, 8, 6, 5, 4, 3, 2, 1, 1], k=r.randint(0, 40))) for i in ids}


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()), "id long, t string")


def asked(spark):
    return spark.createDataFrame([("q1", "the alpha w9"), ("q2", "of beta beta @p"), ("q3", "nothing"), ("q4", "the of")], "q string, t string")


def same(spark, index, docs, k=5):
    """What the index finds is what a search of these documents finds."""
    got = segments.search(index, asked(spark), "q", F.col("t"), k)[0]
    want = search.bm25(frame(spark, docs), "id", F.col("t"), asked(spark), "q", F.col("t"), k)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert (index.n, index.tokens) == (len(docs), sum(len(t.split()) for t in docs.values()))


def test_an_index_that_changes_answers_as_a_fresh_one(spark, tmp_path):
    docs = texts(1, range(150))
    index = segments.add(segments.open_snapshot(spark, str(tmp_path)), frame(spark, docs), "id", F.col("t"))
    same(spark, index, docs)
    old, before = index, dict(docs)
    changed = texts(2, [*range(0, 30), *range(200, 260)])
    docs |= changed
    index = segments.add(index, frame(spark, changed), "id", F.col("t"))
    same(spark, index, docs)
    index = segments.delete(index, spark.createDataFrame([(k,) for k in (*range(20, 80), 999)], "id long"))
    for k in range(20, 80):
        docs.pop(k)
    same(spark, index, docs)
    again = texts(3, range(70, 90))  # among them some that were deleted
    docs |= again
    index = segments.add(index, frame(spark, again), "id", F.col("t"))
    same(spark, index, docs)
    same(spark, old, before)  # a reader keeps its snapshot
    assert len(index.segments) == 3 and segments.open_snapshot(spark, str(tmp_path)) == index
    merged = segments.merge(index)
    same(spark, merged, docs)
    assert len(merged.segments) == 1 and not merged.deletions
    assert segments.vacuum(merged) and segments.open_snapshot(spark, str(tmp_path)) == merged
    same(spark, merged, docs)
    want = {r.term: (r.df, r.cf) for r in merged.terms().collect()}
    assert want == {t: (sum(t in d.split() for d in docs.values()), sum(d.split().count(t) for d in docs.values())) for t in VOCABULARY}


def test_one_of_two_writers_fails(spark, tmp_path):
    start = segments.add(segments.open_snapshot(spark, str(tmp_path)), frame(spark, texts(1, range(5))), "id", F.col("t"))
    segments.add(start, frame(spark, texts(2, range(5, 9))), "id", F.col("t"))
    with pytest.raises(RuntimeError, match="by another"):
        segments.add(start, frame(spark, texts(3, range(9, 12))), "id", F.col("t"))
    assert segments.open_snapshot(spark, str(tmp_path)).n == 9


def test_blocks_are_skipped(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    index = segments.add(segments.open_snapshot(spark, str(tmp_path)), docs, "doc_id", F.col("text"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(segments, "FIRST", 8)
        found, figures = segments.search(index, catalog.questions(spark), "query_id", F.col("query"), 5)
        got = sorted(map(tuple, found.collect()))
        read = figures.agg(F.sum("read") / F.sum("postings")).first()[0]
    want = search.bm25(docs, "doc_id", F.col("text"), catalog.questions(spark), "query_id", F.col("query"), 5)
    assert got == sorted(map(tuple, want.collect())) and read < 0.5


def test_nothing_indexed_and_empty_texts(spark, tmp_path):
    empty = segments.open_snapshot(spark, str(tmp_path))
    assert segments.search(empty, asked(spark), "q", F.col("t"))[0].collect() == [] and segments.merge(empty) is empty and segments.delete(empty, spark.range(1)) is empty
    index = segments.add(empty, spark.createDataFrame([(1, None), (2, ""), (3, "alpha"), (3, "alpha")], "id long, t string"), "id", F.col("t"))
    assert (index.n, index.tokens) == (3, 1)
    assert [(r.q, r.id) for r in segments.search(index, asked(spark), "q", F.col("t"))[0].select(F.col("query_id").alias("q"), "id").collect()] == [("q1", 3)]


def test_texts_are_sent_only_where_an_id_is_there_twice(spark):
    plan = lambda rows: segments.forward(frame(spark, {}).union(spark.createDataFrame(rows, "id long, t string")), "id", F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan([(1, "alpha"), (2, "beta")]) and "Exchange" in plan([(1, "alpha"), (1, "beta")])


def test_deletions_in_turns_and_spread_terms(spark, tmp_path, monkeypatch):
    """The same answers where a term's postings lie in many buckets, and ids of a deletion are sent in several turns."""
    for name, value in (("AT_ONCE", 7), ("SPREAD", 40), ("DEALT", 50)):
        monkeypatch.setattr(segments, name, value)
    docs = texts(5, range(120))
    index = segments.add(segments.open_snapshot(spark, str(tmp_path)), frame(spark, docs).repartition(3), "id", F.col("t"))
    index = segments.delete(index, spark.range(0, 60, 2).toDF("id"))
    same(spark, index, {k: t for k, t in docs.items() if k % 2 or k >= 60})
    left = [t.split() for k, t in docs.items() if k % 2 or k >= 60]
    assert {r.term: (r.df, r.cf) for r in index.terms().collect()} == {t: (sum(t in d for d in left), sum(d.count(t) for d in left)) for t in VOCABULARY}
