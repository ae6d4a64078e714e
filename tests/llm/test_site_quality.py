import math

import pytest
from pyspark.sql import functions as F

from lodestone.llm import site_quality as module
from lodestone.llm.site_quality import features, fit, logit, site_quality

from .util import SF, frame, sample


def labels(spark):
    return spark.read.parquet(f"{SF.replace('0.001', '0.1')}/labels.parquet")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet").where("doc_id < 3000")
    known = labels(spark)
    train, test = known.where("doc_id % 3 <> 0"), known.where("doc_id % 3 = 0")
    rows = site_quality(docs, train).join(test.withColumnRenamed("quality", "q").withColumnRenamed("toxic", "t"), "doc_id").collect()
    clean = [r.kept for r in rows if r.q == 1 and r.t == 0]
    foul = [r.kept for r in rows if r.q == 0 or r.t == 1]
    assert len(clean) > 100 and sum(clean) >= 0.97 * len(clean)
    assert sum(foul) <= 0.15 * len(foul)


def test_pooling_agrees_with_plain_sums(spark):
    docs = sample(spark)
    rows = site_quality(docs, labels(spark)).collect()
    assert len(rows) == docs.count()
    assert all(0 < r.site_prior < 1 and 0 <= r.quality <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.host, r.path), set()).add(r.site_prior)
        assert r.quality == pytest.approx(1 / (1 + 2.718281828459045 ** -(r.evidence + logit(r.site_prior))), abs=1e-9)
    assert all(len(v) == 1 for v in by.values())


def chance(x):
    return 1 / (1 + math.exp(-x))


def pooled(rows, marks, rate):
    """The posterior of each (host, path) from plain sums. rows: (id, host, path, evidence); marks: id -> quality or None."""
    share = lambda r: float(marks[r[0]] > 0) if marks.get(r[0]) is not None else chance(r[3] + logit(rate))

    def sums(key):
        out = {}
        for r in rows:
            n, k = out.get(key(r), (0, 0.0))
            out[key(r)] = (n + 1, k + share(r))
        return out

    def strength(groups):
        many = [(n, k / n, m) for n, k, m in groups if n >= 2]
        mean = lambda xs: sum(xs) / len(xs) if xs else 0.0
        spread, whole, noise = mean([(f - m) ** 2 for _, f, m in many]), mean([m * (1 - m) for _, _, m in many]), mean([m * (1 - m) / n for n, _, m in many])
        between = (spread - noise) / whole if whole else 0.0
        return 1000.0 if between <= 1e-3 else min(1000.0, max(1.0, 1 / between - 1))

    hosts, paths = sums(lambda r: r[1]), sums(lambda r: r[1:3])
    every = (sum(k for _, k in hosts.values()) + 0.5) / (len(rows) + 1)
    w = strength([(n, k, every) for n, k in hosts.values()])
    means = {h: (k + w * every) / (n + w) for h, (n, k) in hosts.items()}
    v = strength([(n, k, means[p[0]]) for p, (n, k) in paths.items()])
    return {p: (k + v * means[p[0]]) / (n + v) for p, (n, k) in paths.items()}, w, v


@pytest.mark.parametrize("odd", [False, True])
def test_posteriors_and_verdicts_agree_with_plain_sums(spark, odd):
    """Host and path sums, both strengths, the prior of each site, quality, toxicity and the verdict, also with clashing columns, repeated rows and null sites."""
    docs, known = sample(spark), labels(spark)
    if odd:
        docs = docs.union(docs.limit(20)).withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source"))).withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang")))
        docs = docs.withColumns({c: F.lit("clash") for c in ("host", "path", "evidence", "h", "q", "p", "n", "k", "quality", "toxic", "kept", "site_prior", "host_mean")})
    good, bad = module.fit_classifiers(docs, known)
    got = site_quality(docs, known).collect()
    marks = {r.doc_id: r.quality for r in known.groupBy("doc_id").agg(F.min("quality").alias("quality")).collect()}
    rows = [(r.doc_id, r.source, r.lang, good.evidence(features(r.text or ""))) for r in docs.select("doc_id", "source", "lang", "text").collect()]
    priors, w, v = pooled(rows, marks, good.rate)
    assert len(got) == len(rows) and 1 <= w <= 1000 and 1 <= v <= 1000
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for r in got:
        evidence = good.evidence(features(texts[r.doc_id]))
        quality, toxic = chance(evidence + logit(priors[r.host, r.path])), chance(bad.evidence(features(texts[r.doc_id])) + logit(bad.rate))
        assert (r.evidence, r.site_prior, r.quality, r.toxic) == pytest.approx((evidence, priors[r.host, r.path], quality, toxic), abs=1e-9)
        assert r.kept == ((not good.weights or quality >= module.REJECT_QUALITY) and (not bad.weights or toxic < module.REJECT_TOXIC))


def test_no_labels_keeps_all(spark):
    none = labels(spark).where("false")
    assert site_quality(frame(spark), none).where("kept").count() == frame(spark).count()
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (3, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert site_quality(frame(spark).union(frame(spark)), odd).count() == 2 * frame(spark).count()
    assert site_quality(frame(spark, []), none).count() == 0


def test_classifier():
    c = fit([{"good"}, {"good", "x"}] * 30 + [{"bad"}, {"bad", "x"}] * 30, [1, 1] * 30 + [0, 0] * 30)
    assert c.evidence({"good"}) > 2 and c.evidence({"bad"}) < -2
    assert features("") and F


def test_a_repeated_id_is_fitted_on_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(module, "fit", lambda rows, marks: seen.append(len(rows)) or fit(rows, marks))
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "two"), (3, None)], "doc_id long, text string")
    known = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    module.fit_classifiers(docs, known)
    assert seen == [3, 3] and module.FIT_ROWS == 4000
