import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lodestone.llm.pii import find_pii, mask, pii_digest

from .util import COLUMNS, frame, pairs, sample

RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
HARD = [
    "a@b.c_d@e.f a@b.cd@e.f x@y @z.q a.b+c@d-e.f.g.", "1.2.3.4.5.6.7.8.9 256.1.1.1 01.002.0003.255 1.2.3", "😀 +1 (555) 123-4567 é +12 34 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559 41111111111111111111111", "4111  1111 1111 1111 4012888888881881.", "IBAN GB82 WEST 1234 5698 7654 32, DE89370400440532013000, GB82 WEST 1234 5698 7654 33",
    'token = "586908a73d53ffc7776756ed304e7317d1aabbcc" 586908a73d53ffc7776756ed304e7317d1aabbcc', "@" * 50 + "a" * 5000 + "@x.y", "1-" * 4000, "+1" + " " * 3000, "1." * 5000, "+1 234 567 890+1 234 567 891",
]


def ok(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    return [[(m.start(), m.end()) for m in re.finditer(p, text) if ok(k, m.group())] for k, p in RULES]


def hard(spark):
    return spark.createDataFrame([(100 + i, t, None, None, None, None, None) for i, t in enumerate(HARD)], COLUMNS)


@pytest.mark.parametrize("source", [frame, sample, hard])
def test_base_agrees_with_brute_force(spark, source):
    df = source(spark)
    got = {r.doc_id: r for r in pii_digest(df).collect()}
    for i, t in pairs(df):
        spans = brute(t)
        text = ",".join(f"{k}:{a}:{b}" for (k, _), s in zip(RULES, spans) for a, b in s)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == list(map(len, spans)), t[:80]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t[:80]
        assert r.spans.startswith(text)


def test_method_adds_confirmed_and_near_spans(spark):
    got = {r.doc_id: r.spans for r in pii_digest(hard(spark)).collect()}
    assert got[105].count("iban") == 2  # mod 97 drops the third
    assert got[106].count("secret:9:49") == 1


def many(n):
    """Addresses side by side, with a few of other kinds between them, and what masks them."""
    r = random.Random(6)
    items = [(f"u{i}@h{i}.example", "EMAIL") if (k := r.random()) < 0.9 else (f"10.{i % 256}.3.4", "IP") if k < 0.95 else ("card 4111 1111 1111 1111", "CARD") for i in range(n)]
    text, out = "é ", "é "
    for x, kind in items:
        text += x + ", "
        out += ("card [CARD]" if kind == "CARD" else f"[{kind}]") + ", "
    return text, out


@pytest.mark.parametrize("n", [100, 700, 100_000])
def test_time_does_not_grow_with_the_square_of_spans(spark, n):
    text, out = many(n)
    joined = "@".join(f"a{i}.b" for i in range(n))
    df = spark.createDataFrame([(1, text), (2, joined)], "doc_id long, text string")
    pii_digest(df.where("doc_id = 0")).collect()
    began = time.monotonic()
    for r in pii_digest(df).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for (k, _), s in zip(RULES, brute(text if r.doc_id == 1 else joined)) for a, b in s).encode()).hexdigest()
    assert find_pii(df.where("doc_id = 1")).select(mask(F.col("text"), F.col("pii")).alias("m")).first().m == out
    assert time.monotonic() - began < 60


def test_mask_agrees_with_plain_python(spark):
    r = random.Random(9)
    rows = []
    for i in range(60):
        n = r.choice([1, 3, 300, 5000])
        text = "".join(r.choice("abé😀 ") for _ in range(n))
        spans = [(k := r.randrange(n), min(n, k + r.randint(1, 30)), r.choice(["email", "ip"]), 1.0) for _ in range(r.choice([0, 1, 5, 600]))]
        rows.append((i, text, [(kind, a, b, s) for a, b, kind, s in spans]))
    df = spark.createDataFrame(rows, "doc_id long, text string, pii array<struct<kind:string,start:int,end:int,score:double>>")
    for x in df.withColumn("m", mask(F.col("text"), F.col("pii"))).collect():
        out, at = "", 0
        for a, b, kind in sorted((s.start, s.end, s.kind) for s in x.pii):
            if a >= at:
                out += x.text[at:a] + f"[{kind.upper()}]"
            at = max(at, b)
        assert x.m == out + x.text[at:]


def test_repeated_rows(spark):
    twice = frame(spark).union(frame(spark)).union(spark.createDataFrame([(None, "x@y.zz", None, None, None, None, None)], COLUMNS))
    rows = pii_digest(twice).collect()
    assert len(rows) == twice.count() and len({tuple(r) for r in rows}) == frame(spark).count() + 1


def test_mask(spark):
    out = {r.doc_id: r.m for r in find_pii(hard(spark)).withColumn("m", mask(F.col("text"), F.col("pii"))).collect()}
    assert out[103].startswith("[CARD] and 4111-1111-1111-1112 5500005555555559 ")  # one run of too many digits
    assert out[111] == "[PHONE][PHONE]"
    assert out[104].startswith("4111  1111")


def test_empty(spark):
    assert pii_digest(frame(spark, [])).count() == 0
