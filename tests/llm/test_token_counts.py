import random

import pytest
from tokenizers import Tokenizer

from lodestone.llm.queries import tokenizer_path
from lodestone.llm.token_counts import PrefixIndex, TokenCounter, token_counts

from .util import frame, pairs, sample

PATH = tokenizer_path("byte_bpe_50k.json")


def test_repeated_and_null_ids(spark):
    from .util import COLUMNS

    twice = frame(spark).union(frame(spark)).union(spark.createDataFrame([(None, "a b c", None, None, None, None, None)] * 2, COLUMNS))
    rows = [tuple(r) for r in token_counts(twice, PATH).collect()]
    assert len(rows) == twice.count() and sum(r[0] is None for r in rows) == 2 and len(set(rows)) == frame(spark).count() + 1


@pytest.mark.parametrize("source", [frame, sample])
def test_agrees_with_the_library(spark, source):
    df = source(spark)
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in token_counts(df, PATH, 50).collect()}
    for i, t in pairs(df):
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 50), i
        assert (got[i].fit_chars == len(t)) == (n <= 50)
    assert token_counts(frame(spark, []), PATH).count() == 0


def test_every_prefix():
    counter, library, r = TokenCounter(PATH), Tokenizer.from_file(PATH), random.Random(3)
    for _ in range(60):
        t = "".join(r.choice(["a", "the ", "  ", "\n", "'re", "12", "é", "!!", " don't", "lowering", "你好", "<|endoftext|>", "zzzzzz"]) for _ in range(12))
        index = PrefixIndex(counter, t)
        for k in range(len(t) + 1):
            assert index.count(k) == len(library.encode(t[:k], add_special_tokens=False).ids), (t, k)
        for budget in (0, 1, 5, 9, 100):
            assert index.count(index.truncate(budget)) <= max(budget, 0) + 1
