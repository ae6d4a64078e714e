"""Quality rules by repetition coverage.

Words and lines are taken from the UTF-8 bytes of whole texts; rolling hashes of several n-gram lengths (numpy, many
documents at once) tell which characters lie inside duplicated n-grams and duplicated lines. Words and lines are equal if
their 64-bit hashes are, n-grams if the rolling hashes of their words are. Map-only: no shuffle.

Cases: a null or empty text has no word (all counts 0, base_failed, not kept). Repeated doc_ids and further columns are
no concern: each row is judged alone and only the id and text columns are read. A null id is returned as it is. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, chunks, covered, mix, repeated, span_hashes, words_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 5  # of the base's repeated words
#: Largest share of word characters inside n-grams found twice or more in the text, by n; the published limits for 5 to 10 words.
LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.30  # largest share of word characters inside lines equal to an earlier line

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, dup_line_share double, " + ", ".join(f"dup_{n}gram_share double" for n in LIMITS)
)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each text of a buffer; every text ends in a line feed that is not its own."""
    n, heads = len(offsets) - 1, offsets[:-1]
    start, end = words_of(data)
    doc = np.searchsorted(offsets, start, "right") - 1
    n_words = np.bincount(doc, minlength=n)
    points = np.zeros(len(data) + 1, np.int64)
    inside = np.zeros(len(data), bool)
    inside[:] = covered(len(data), start, end)
    np.cumsum(((data & 0xC0) != 0x80) & inside, out=points[1:])
    chars = points[offsets[1:]] - points[heads]

    stop = np.flatnonzero(data == 10)
    head = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else stop
    in_line = points[stop] - points[head]
    head, stop, in_line = (x[in_line > 0] for x in (head, stop, in_line))
    line_doc = np.searchsorted(offsets, head, "right") - 1
    keys = span_hashes(data, head, stop) ^ mix(line_doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order][1:] == keys[order][:-1]
    out = {
        "n_words": n_words,
        "word_chars": chars,
        "n_symbols": np.add.reduceat(_IS_SYMBOL[data], heads, dtype=np.int64) if n else heads,
        "n_dup_lines": np.bincount(line_doc[later], minlength=n),
    }
    least = np.maximum(chars, 1)
    out["dup_line_share"] = np.bincount(line_doc[later], in_line[later], n) / least

    word = span_hashes(data, start, end)
    salt = mix(doc.astype(np.uint64) + np.uint64(7))
    width = points[end] - points[start]
    gram = np.zeros(len(word), np.uint64)
    failed = out["dup_line_share"] > LINE_LIMIT
    for k in range(1, max(LIMITS) + 1):
        m = len(word) - k + 1
        if m > 0:
            gram = gram[:m] * np.uint64(0xC2B2AE3D27D4EB4F) + word[k - 1 :]
        if k not in LIMITS:
            continue
        if m > 0:
            whole = np.flatnonzero(doc[:m] == doc[k - 1 :])
            twice = whole[repeated(mix(gram[whole]) ^ salt[whole])]
            hit = covered(len(word), twice, twice + k)
        else:
            hit = np.zeros(len(word), bool)
        if k == WINDOW:
            out["n_repeat_words"] = np.bincount(doc[hit], minlength=n)
        share = out[f"dup_{k}gram_share"] = np.bincount(doc[hit], width[hit], n) / least
        failed |= share > LIMITS[k]
    out["base_failed"] = (n_words < 10) | (100 * out["n_repeat_words"] > 20 * n_words)
    out["kept"] = ~(out["base_failed"] | failed)
    return out


def repetition_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the base counts, the shares inside duplicates, base_failed and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in chunks(batch.column(1)):
                got = measure(data, offsets)
                columns = {"doc_id": ids.slice(first, end - first).cast(pa.int64())} | {k: pa.array(v.astype(np.int64) if v.dtype.kind in "iu" else v) for k, v in got.items()}
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([columns[k] for k in names], names)

    bounded_batches(docs.sparkSession)
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, SCHEMA)
