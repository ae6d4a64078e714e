"""Fixtures with the awkward cases that every operator must bear."""

import random
import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward() -> list[tuple]:
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(60)]
    long = " ".join(r.choice(vocab) for _ in range(30_000))
    base = " ".join(r.choice(vocab) for _ in range(120))
    texts = [None, "", " \n\t ", "one", base, base, base + " tail", "x" + base[5:], "a b c d e a b c d e f a b c d e",
             "line one\nline one\n\nline two\nline one", "Zażółć 你好 😀😀  nb sp 'll don't", long, "0 " * 500, "ﬁ İstanbul <|endoftext|> x",
             "9" * 3000, "!?" * 700]
    return [(i, t, None if i % 5 == 0 else "en", None if i % 3 == 0 else "src0", None if t is None else len(t), "clash", i) for i, t in enumerate(texts)]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score long"


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, COLUMNS)


def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df) -> list[tuple]:
    """(doc_id, text) of a frame, null as empty."""
    return [(x.doc_id, x.text or "") for x in df.select("doc_id", "text").collect()]
