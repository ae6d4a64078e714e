"""What run() writes after each stage, against the same chain in plain Python over a small table."""

import glob
import math
import os
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from lodestone.llm.pii import find_pii
from lodestone.llm.queries import tokenizer_path
from lodestone.llm.site_quality import REJECT_QUALITY, REJECT_TOXIC, features, fit_classifiers, logit

from .test_simhash import brute_components, brute_print
from .util import SF


def chance(x):
    return 1 / (1 + math.exp(-x))


def strength(groups):
    many = [(n, k, m) for n, k, m in groups if n >= 2]
    spread, whole, noise = (float(np.mean(x)) if many else 0.0 for x in ([(k / n - m) ** 2 for n, k, m in many], [m * (1 - m) for _, _, m in many], [m * (1 - m) / n for n, _, m in many]))
    between = (spread - noise) / whole if whole else 0.0
    return 1000.0 if between <= 1e-3 else min(1000.0, max(1.0, 1 / between - 1))


def kept_ids(docs, marks, good, bad):
    """docs: id -> (text, host, path); marks: id -> quality."""
    found = {i: features(t or "") for i, (t, _, _) in docs.items()}
    paths, hosts = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for i, (_, h, q) in docs.items():
        share = float(marks[i] > 0) if marks.get(i) is not None else chance(good.evidence(found[i]) + logit(good.rate))
        for group in (paths[h, q], hosts[h]):
            group[0] += 1
            group[1] += share
    rate = (sum(k for _, k in hosts.values()) + 0.5) / (len(docs) + 1)
    w = strength([(n, k, rate) for n, k in hosts.values()])
    mean = {h: (k + w * rate) / (n + w) for h, (n, k) in hosts.items()}
    w = strength([(n, k, mean[h]) for (h, _), (n, k) in paths.items()])
    prior = {(h, q): (k + w * mean[h]) / (n + w) for (h, q), (n, k) in paths.items()}
    fine = lambda i, h, q: (not good.weights or chance(good.evidence(found[i]) + logit(prior[h, q])) >= REJECT_QUALITY) and (not bad.weights or chance(bad.evidence(found[i]) + logit(bad.rate)) < REJECT_TOXIC)
    return {i for i, (_, h, q) in docs.items() if fine(i, h, q)}


def without_repeats(texts):
    data, first = {i: t.encode() for i, t in texts.items()}, {}
    for i in sorted(data):
        for at in range(len(data[i]) - 49):
            first.setdefault(data[i][at : at + 50], i)
    out = {}
    for i, b in data.items():
        stays = np.ones(len(b), bool)
        for at in range(len(b) - 49):
            if first[b[at : at + 50]] < i:
                stays[at : at + 50] = False
        out[i] = np.frombuffer(b, np.uint8)[stays].tobytes().decode("utf-8", "ignore")
    return out


def masked(text, spans):
    out, at = "", 0
    for start, end, kind in sorted((s.start, s.end, s.kind) for s in spans):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_run_is_the_chain(spark):
    table, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    source = {r.doc_id: r for r in table.collect()}
    pieces = p.run(spark, SF, keep=True).collect()
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    last = max(glob.glob(f"{folder}/pipeline-*"), key=os.path.getmtime)
    written = [spark.read.parquet(f"{last}/{k}").collect() for k in range(4)]
    assert all(len({r.doc_id for r in rows}) == len(rows) for rows in written)
    one, two, three, four = ({r.doc_id: r.text for r in rows} for rows in written)

    marks = {r.doc_id: r.quality for r in known.groupBy("doc_id").agg(F.min("quality").alias("quality")).collect()}
    want = kept_ids({i: (r.text, r.source, r.lang) for i, r in source.items()}, marks, *fit_classifiers(table, known))
    assert one == {i: source[i].text for i in want} and 0 < len(want) < len(source)

    parts = brute_components({i: brute_print(t or "") for i, t in one.items()})
    assert two == {i: one[i] for i in one if parts[i] == i} and len(two) < len(one)

    assert three == (cut := without_repeats({i: t or "" for i, t in two.items()})) and cut != two

    spans = {r.doc_id: r.pii for r in find_pii(spark.createDataFrame(list(cut.items()), "doc_id long, text string")).collect()}
    assert four == (want := {i: masked(t, spans[i]) for i, t in cut.items()}) and want != cut
    for rows in written[2:]:
        assert all((r.lang, r.source, r.n_chars) == (source[r.doc_id].lang, source[r.doc_id].source, len(r.text)) for r in rows)

    library, by_doc = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == four.keys()
    for i, t in four.items():
        ids, at = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
