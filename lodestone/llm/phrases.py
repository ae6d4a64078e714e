"""Phrases of two to MAX words whose words stand together more often than by chance, per language.

All 1- to MAX-grams within pieces become rows of language, phrase and count, hash-aggregated per language; the counts of each phrase's two
parts are joined to every cut of it, the score of a cut is exact in Decimal, phrases that are as frequent in a one-word extension go by an
anti-join, and what is left is ranked in a window. One-word extensions are enough: of a longer phrase around a phrase, the part that is one word longer than that
is at least as frequent as the whole.

Most n-grams of a corpus are rare, and a row for each would be many times the text. A phrase cannot be frequent if two of its neighbouring words are not, so
pairs are counted first, by 64-bit hashes, over all rows. The frequent ones become a Bloom filter of at most FILTER bits, whatever the size of the
corpus, that is sent to all tasks, and n-grams with a pair that it does not hold are left out. Hashes and the filter can only let more n-grams through; these are then counted
as text, and only exact counts decide. Within a block of about BLOCK bytes equal n-grams are one row already, so a frequent phrase is one
row of each block.

Cases: a null text is empty and has no words. A null language is `und` (and counts together with a language of that name). Empty texts, blanks and lone marks give nothing.
Repeated rows count as often as they stand. Texts of any length are read whole. An empty table gives an empty table; ids and further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .common import bounded_batches, ensure_checkpoint_dir, mix, text_bytes, tidy

MAX, LEAST, SHARE, BEST = 5, 100, 100, 2000
UNKNOWN = "und"
BLOCK = 8 << 20  # bytes of text whose equal n-grams are one row
FILTER = 1 << 28  # most bits of the filter of frequent pairs: 32 MB
BITS = 16  # bits of the filter for each pair, while they last
SEGMENT = 16  # bits of a place within one row of the filter
PROBES = 3
RANGES = 32  # in which candidates are ranked first
LANGS = 10_000  # most languages whose totals are sent to all tasks

#: What ends a piece, and what parts words within one.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(ENDS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNTS = "lang string, phrase string, n int, c long"


class Piecewise:
    """The words of texts of one language: codes of equal words, and how many words follow each within its piece."""

    def __init__(self, data: np.ndarray, lang: str) -> None:
        data = _LOWER[data]
        kind = _KIND[data]
        edge = np.diff((kind == 0).view(np.int8), prepend=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # texts end with what ends a piece
        n = len(start)
        piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        cuts = np.stack((start, end), 1).ravel()
        array = pa.Array.from_buffers(pa.large_string(), max(0, 2 * n - 1), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        coded = array.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.joined = piece[1:] == piece[:-1]  # with the next word
        self.lang = lang
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        self.hash = mix(np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.words.cast(pa.large_binary()).to_pylist()], np.uint64))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each pair, and what tells pairs of this block apart."""
        at = np.flatnonzero(self.joined)
        return at, self.code[at] * len(self.words) + self.code[at + 1]

    def pair_hash(self, at: np.ndarray) -> np.ndarray:
        return mix(self.hash[self.code[at]] * np.uint64(0x9E3779B97F4A7C15) + self.hash[self.code[at + 1]])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Piecewise]:
    """Texts (column 1) by language (column 0), in blocks of about BLOCK bytes."""

    def of(held: list[pa.RecordBatch]) -> Iterator[Piecewise]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        langs = rows.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            data, _ = text_bytes(rows.column(1).filter(pc.equal(langs.indices, k)), b"\n")
            if len(data):
                yield Piecewise(data, lang)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= BLOCK:
            yield from of(held)
            held, size = [], 0
    if held:
        yield from of(held)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x in _blocks(batches):
        at, key = x.pairs()
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(x.pair_hash(at[first]).view(np.int64)), pa.array(count)], ["h", "c"])


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits (bits: a power of two) of each hash, one column a probe."""
    return np.stack([mix(h + np.uint64(k)) & np.uint64(bits - 1) for k in range(PROBES)], 1)


def _filter(pairs: DataFrame) -> tuple[int, np.ndarray]:
    """A Bloom filter (bits, bytes) of the hashes h: at most FILTER bits, made by segments on the executors."""
    n = pairs.count()
    bits = min(FILTER, max(1 << SEGMENT, 1 << (max(1, n * BITS) - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch.column(0).to_numpy().view(np.uint64), bits).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> SEGMENT), pa.array((at & (1 << SEGMENT) - 1).astype(np.int32))], ["segment", "place"])

    def segment(key: tuple, rows: pa.Table) -> pa.Table:
        mask = np.zeros(1 << SEGMENT, bool)
        mask[rows.column("place").to_numpy()] = True
        return pa.table({"segment": [key[0].as_py()], "bits": pa.array([np.packbits(mask, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    wide = (1 << SEGMENT) // 8
    # at most FILTER / 2^SEGMENT rows
    for row in pairs.select("h").mapInArrow(places, "segment long, place int").groupBy("segment").applyInArrow(segment, "segment long, bits binary").collect():
        out[row.segment * wide : (row.segment + 1) * wide] = np.frombuffer(row.bits, np.uint8)
    return bits, out


def _explode(most: int, bits: int, table):
    """Rows of all n-grams of a block, counted, whose pairs the filter holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = table.value
        for x in _blocks(batches):
            def rows(codes: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
                words = [x.words.take(pa.array(c)) for c in codes]
                phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if len(words) > 1 else words[0]
                n = len(phrase)
                return pa.RecordBatch.from_arrays([pa.array([x.lang] * n, pa.string()), phrase.cast(pa.string()), pa.array(np.full(n, len(words), np.int32)), pa.array(count)], ["lang", "phrase", "n", "c"])

            count = np.bincount(x.code, minlength=len(x.words))
            yield rows([np.arange(len(x.words))], count)
            at, key = x.pairs()
            distinct, first, of = np.unique(key, return_index=True, return_inverse=True)
            hold = np.ones(len(distinct), bool)
            for place in _places(x.pair_hash(at[first]), bits).T:
                hold &= (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
            kept = np.full(len(x.code), -1)  # a number of the pair from each word on, if it may be frequent
            kept[at] = np.where(hold[of], of, -1)
            gram = kept  # and of the n-gram
            for n in range(2, most + 1):
                here = np.flatnonzero(gram >= 0)
                if n > 2:  # an n-gram is the (n - 1)-gram and the pair at its end
                    here = here[here + n - 2 < len(kept)]
                    here = here[kept[here + n - 2] >= 0]
                    key = gram[here] * len(distinct) + kept[here + n - 2]
                else:
                    key = gram[here]
                if not len(here):
                    break
                _, first, of, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                yield rows([x.code[here[first] + k] for k in range(n)], count)
                gram = np.full(len(kept), -1)
                gram[here] = of

    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = MAX, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The counts (lang, phrase, n, c) of all words and of all phrases of at most `most` words seen `least` times or more; and the words of each language (lang, total)."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    bounded_batches(spark)
    texts = docs.select(F.coalesce(docs[lang_col], F.lit(UNKNOWN)).alias("lang"), docs[text_col].alias("text")).where(F.col("text").isNotNull())
    pairs = texts.mapInArrow(tidy(_count_pairs), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least).select("h").checkpoint()
    bits, table = _filter(pairs)
    rows = texts.mapInArrow(tidy(_explode(most, bits, spark.sparkContext.broadcast(table))), COUNTS)
    counted = rows.groupBy("lang", "phrase", "n").agg(F.sum("c").alias("c"))
    counts = counted.where((F.col("n") == 1) | (F.col("c") >= least)).checkpoint()
    return counts, counts.where("n = 1").groupBy("lang").agg(F.sum("c").alias("total")).checkpoint()


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = MAX, least: int = LEAST, share: int = SHARE, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases.

    a: the phrase's count, l and r: those of the parts at the cut that scores least, n: words of the language, score: floor(1000 a n / (l r)).
    share: a phrase goes if a longer candidate around it has at least this percentage of its count.
    """
    counts, totals = phrase_counts(docs, text_col, lang_col, most, least)
    parts = counts.where(F.col("c") >= least).select("lang", "phrase", "c")
    found = counts.where("n > 1").select("lang", "phrase", "n", F.col("c").alias("a"))
    # no one-word extension holds its place
    around = found.where("n > 2").select("lang", F.split("phrase", " ").alias("w"), "n", F.col("a").alias("longer"))
    inner = around.select("lang", F.explode(F.array(F.expr("array_join(slice(w, 1, n - 1), ' ')"), F.expr("array_join(slice(w, 2, n - 1), ' ')"))).alias("phrase"), "longer")
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = DecimalType(38, 0)
    held = (F.lit(100).cast(wide) * F.col("longer") >= F.lit(share).cast(wide) * F.col("a"))
    found = found.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False))).drop("longer")
    # every cut, with the counts of its parts
    cuts = found.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.expr("sequence(1, n - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, n - k), ' ')").alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
    totals = totals.withColumnRenamed("total", "n")
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= LANGS else totals, "lang")
    cuts = cuts.withColumn("score", F.expr("(1000bd * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")
    # ranges first, so that no task sorts all of a language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANGES))).orderBy(*order)
    lowest = lowest.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= best)
    ranked = lowest.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
