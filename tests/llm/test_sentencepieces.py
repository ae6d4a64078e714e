import random
import zlib

import numpy as np
import pytest
import sentencepiece

from lodestone.llm.queries import tokenizer_path
from lodestone.llm.sentencepieces import codec, decode_pieces, encode_pieces, piece_round_trip

from .util import frame, pairs, sample

PATH = tokenizer_path("piece_bpe_32k.model")


def test_repeated_and_null_ids(spark):
    from .util import COLUMNS

    twice = frame(spark).union(frame(spark)).union(spark.createDataFrame([(None, "a b c", None, None, None, None, None)] * 2, COLUMNS))
    rows = [tuple(map(repr, r)) for r in piece_round_trip(twice, PATH).collect()]
    assert len(rows) == twice.count() and len(set(rows)) == frame(spark).count() + 1


def test_random_texts_agree_with_the_library():
    library, r = sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(6)
    bits = [" ", "  ", "\n", "\t", "a", "the", "lower", "日本", "é", "😀", "▁", "<s>", "1234", "ing", "!!", "\0", "]", "-", "^", "\\", " " * 11, " " * 37, "qzx", "ﬁ"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(1500)] + [" " * n for n in range(120)] + [" " * 1000 + "x"]
    for t, got in zip(texts, codec(PATH).encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(t), repr(t)
        assert codec(PATH).decode(got) == t.replace("▁", " "), repr(t)


@pytest.mark.parametrize("source", [frame, sample])
def test_agrees_with_the_library(spark, source):
    df = source(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in piece_round_trip(df, PATH).collect()}
    for i, t in pairs(df):
        ids = library.encode(t)
        assert (got[i].n_pieces, got[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        assert got[i].round_trip
    assert piece_round_trip(frame(spark, []), PATH).count() == 0


def test_columns(spark):
    df = decode_pieces(encode_pieces(frame(spark), PATH), PATH)
    assert all((r.text or "") == r.decoded for r in df.collect())
