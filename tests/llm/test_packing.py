import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestone.llm.packing import harmonic_pack
from lodestone.llm.queries import tokenizer_path

from .util import frame, pairs, sample

PATH = tokenizer_path("word_bpe_49k.json")


def test_repeated_and_null_ids(spark):
    from .util import COLUMNS

    twice = frame(spark).union(frame(spark)).union(spark.createDataFrame([(None, "a b c", None, None, None, None, None)] * 3, COLUMNS))
    rows = harmonic_pack(twice, tokenizer_path("word_bpe_49k.json")).collect()
    once = harmonic_pack(frame(spark), tokenizer_path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in rows if r.doc_id is not None) == 2 * sum(r.length for r in once)
    assert sorted(r.start for r in rows if r.doc_id is None and r.start == 0) == [0, 0, 0]
    places = [(r.sequence_id, r.offset + k) for r in rows for k in (0, r.length - 1)]
    assert len({p for p in places if p}) <= len(places)
    fill = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():  # no gap, no overlap
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n


@pytest.mark.parametrize("source", [frame, sample])
def test_every_id_lies_in_one_piece(spark, source):
    df = source(spark)
    library = Tokenizer.from_file(PATH)
    rows = harmonic_pack(df, PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in pairs(df):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes()), i
            at += r.length
        assert at == len(ids)
    padded = used = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and {r.padded_length for r in pieces} == {at if at & (at - 1) == 0 else 4096}
        used, padded = used + at, padded + pieces[0].padded_length
    assert used / padded > 0.97


def test_empty(spark):
    assert harmonic_pack(frame(spark, []), PATH).count() == 0
