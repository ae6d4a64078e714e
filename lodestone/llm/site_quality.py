"""Quality classification by hierarchical empirical Bayes.

A document classifier (logistic regression on the words and shapes that tell labels apart, fitted on a bounded sample of
labelled rows) gives each document evidence. Documents are pooled by host and by path with grouped aggregation over all
rows, a labelled one by its label and any other by its evidence; beta priors, their strengths found from the spread of the
groups, shrink a path toward its host and a host toward the whole corpus, so sparse sites speak softly. A document's
quality is its evidence on top of its path's posterior. Toxicity is judged by evidence on the corpus' own rate.

A host with a third of all rows is one row of the pooled table; hosts and paths are joined back by equality, which
adaptive execution splits when skewed.

Cases: a null or empty text has no words, and whatever evidence its shape gives. Null hosts and paths are sites of their
own. Labels may be missing, partly null, or repeated (a document's smallest quality and largest toxicity count), and of
a repeated id only the smallest text is fitted on; with none, or one class only, evidence is 0 and every document is
kept. Repeated rows stay. Further columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, ensure_checkpoint_dir, tidy

FIT_ROWS = 4000  # bound of the labelled rows that the classifier is fitted on: those of least hash
FEATURES = 600  # most features of a classifier
LEAST_SEEN, LEAST_GAIN = 5, 24.0  # rows with a feature, and its likelihood-ratio statistic
REJECT_QUALITY, REJECT_TOXIC = 0.5, 0.15

_WORDS = re.compile(r"[^\W_]+")
_SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def _level(x: float) -> int:
    return min(9, int(10 * x))


def features(text: str) -> set[str]:
    """The words of a text, lower-cased, and its shape in tenths."""
    spaced = _SPACED.findall(text)
    n = max(len(spaced), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    joined = [hash(tuple(spaced[i : i + 5])) for i in range(max(0, len(spaced) - 4))]
    shape = {
        "capitals": sum(map(str.isupper, spaced)) / n,
        "marked": sum(w[-1] in "#*$%&|<>!" for w in spaced) / n,
        "bars": sum(w == "|" for w in spaced) / n,
        "repeats": 1 - len(set(joined)) / len(joined) if joined else 0.0,
        "same lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
        "few kinds": len(set(spaced)) / n,
    }
    return set(_WORDS.findall(text.lower())) | {f"\0{k} {_level(v)}" for k, v in shape.items()} | {f"\0words {len(spaced).bit_length()}"}


@dataclass(frozen=True)
class Classifier:
    """Logistic regression over chosen features, calibrated to the rate of its own sample."""

    weights: dict[str, float]
    bias: float
    rate: float

    def evidence(self, found: set[str]) -> float:
        """Log likelihood ratio of the class."""
        return self.bias + sum(self.weights[k] for k in found & self.weights.keys()) - logit(self.rate)


def logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def fit(rows: list[set[str]], labels: list[int]) -> Classifier:
    n, ones = len(labels), sum(labels)
    if not n or ones in (0, n):
        rate = ones / n if n else 0.5
        return Classifier({}, logit(rate), rate)
    total: dict[str, int] = {}
    hit: dict[str, int] = {}
    for found, y in zip(rows, labels, strict=True):
        for k in found:
            total[k] = total.get(k, 0) + 1
            hit[k] = hit.get(k, 0) + y
    p = ones / n

    def gain(k: str) -> float:
        """Likelihood ratio of telling the rows with a feature from those without."""

        def part(a: int, m: int) -> float:
            return sum(x * math.log(x / (m * q)) for x, q in ((a, p), (m - a, 1 - p)) if x)

        return 2 * (part(hit[k], total[k]) + part(ones - hit[k], n - total[k]))

    ranked = sorted(((-g, k) for k in total if LEAST_SEEN <= total[k] < n and (g := gain(k)) >= LEAST_GAIN))
    seen_in = dict.fromkeys((k for _, k in ranked), 0)
    for r, found in enumerate(rows):
        for k in found & seen_in.keys():
            seen_in[k] |= 1 << r
    names: list[str] = []
    for _, k in ranked:  # features of the same rows, as the words of a text and its copies are, count once
        if len(names) < FEATURES and not any(5 * (seen_in[k] & seen_in[o]).bit_count() >= 3 * (seen_in[k] | seen_in[o]).bit_count() for o in names):
            names.append(k)
    place = {k: i for i, k in enumerate(names)}
    x = np.zeros((n, len(names) + 1))
    x[:, -1] = 1
    for r, found in enumerate(rows):
        for k in found & place.keys():
            x[r, place[k]] = 1
    y, w = np.array(labels, float), np.zeros(len(names) + 1)
    ridge = np.append(np.full(len(names), 0.3), 1e-6)
    for _ in range(25):  # Newton's method
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - q) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(dict(zip(names, w[:-1].tolist(), strict=True)), float(w[-1]), p)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row of labels for each document."""
    return labels.select(labels.doc_id.cast("long").alias("doc_id"), labels.quality.cast("int").alias("quality"), labels.toxic.cast("int").alias("toxic")).where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def fit_classifiers(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> tuple[Classifier, Classifier]:
    """Classifiers of quality and of toxicity from the `most` labelled documents of least hash, one text (the smallest) of each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features(t.as_py() or "")) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.string()))], ["doc_id", "quality", "toxic", "found"])

    ensure_checkpoint_dir(docs.sparkSession)
    chosen = _labelled(docs, labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "toxic", "text").mapInArrow(tidy(run), "doc_id long, quality int, toxic int, found array<string>").checkpoint()
    # features of fewer rows than a classifier may use stay on the executors
    each = rows.select("doc_id", F.explode("found").alias("f"))
    often = each.groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_SEEN).select("f")
    some = each.join(often, "f").groupBy("doc_id").agg(F.array_sort(F.collect_list("f")).alias("found"))
    got = rows.select("doc_id", "quality", "toxic").join(some, "doc_id", "left").select("quality", "toxic", F.coalesce("found", F.array().cast("array<string>")).alias("found")).collect()
    got.sort(key=lambda r: (r.found, r.quality or 0, r.toxic or 0))  # whatever the order of arrival

    one_of: dict[str, str] = {}  # a word's string is kept once
    sets = [{one_of.setdefault(k, k) for k in r.found} for r in got]
    marks = [(r.quality, r.toxic) for r in got]
    del got

    def one(place: int) -> Classifier:
        known = [(s, int(m[place] > 0)) for s, m in zip(sets, marks, strict=True) if m[place] is not None]
        return fit([k for k, _ in known], [y for _, y in known])

    return one(0), one(1)


def _log_odds(p: Column) -> Column:
    p = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    return F.log(p / (1 - p))


def _chance(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(groups: DataFrame, mean: Column) -> float:
    """The beta prior's weight in rows, from how far groups of 2 rows or more stray from their prior mean."""
    m = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), mean))
    got = groups.where("n >= 2").select((F.pow(F.col("k") / F.col("n") - m, 2)).alias("s"), (m * (1 - m)).alias("v"), F.col("n").alias("n")).agg(F.avg("s"), F.avg("v"), F.avg(F.col("v") / F.col("n"))).first()
    spread, whole, noise = (x or 0.0 for x in got)
    between = (spread - noise) / whole if whole else 0.0  # share of the variance that lies between groups
    return 1000.0 if between <= 1e-3 else min(1000.0, max(1.0, 1 / between - 1))


def site_quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None) -> DataFrame:
    """doc_id, host, path, evidence, site_prior, quality, toxic, kept for each row of docs."""
    ensure_checkpoint_dir(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    host = docs["source"] if host is None else host
    path = docs["lang"] if path is None else path
    good, bad = fit_classifiers(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged_ = [(good.evidence(f), bad.evidence(f)) for f in (features(t.as_py() or "") for t in batch.column(3))]
            both = [pa.array([x[k] for x in judged_], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *both], ["doc_id", "host", "path", "evidence", "toxic_evidence"])

    judged = (
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), docs["text"].alias("text"))
        .mapInArrow(tidy(run), "doc_id long, host string, path string, evidence double, toxic_evidence double")
        .checkpoint()
    )
    soft = judged.join(_labelled(docs, labels).select("doc_id", "quality"), "doc_id", "left").withColumn("p", F.coalesce(F.when(F.col("quality") > 0, 1.0).when(F.col("quality") == 0, 0.0), _chance(F.col("evidence") + logit(good.rate))))
    paths = soft.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("k")).checkpoint()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = (x or 0 for x in hosts.agg(F.sum("n"), F.sum("k")).first())
    rate = (k + 0.5) / (n + 1)
    host_weight = _strength(hosts, F.lit(rate))
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("k") + host_weight * rate) / (F.col("n") + host_weight)).alias("host_mean"))
    under = paths.join(hosts, paths.host.eqNullSafe(hosts.h))
    path_weight = _strength(under, F.col("host_mean"))
    sites = under.select(F.col("host").alias("h"), F.col("path").alias("q"), ((F.col("k") + path_weight * F.col("host_mean")) / (F.col("n") + path_weight)).alias("site_prior"))
    out = judged.join(sites, judged.host.eqNullSafe(sites.h) & judged.path.eqNullSafe(sites.q))
    quality = _chance(F.col("evidence") + _log_odds(F.col("site_prior")))
    toxic = _chance(F.col("toxic_evidence") + logit(bad.rate))
    out = out.withColumns({"quality": quality, "toxic": toxic})
    kept = (F.col("quality") >= REJECT_QUALITY) if good.weights else F.lit(True)
    kept = kept & ((F.col("toxic") < REJECT_TOXIC) if bad.weights else F.lit(True))
    return out.select("doc_id", "host", "path", "evidence", "site_prior", "quality", "toxic", kept.alias("kept"))
