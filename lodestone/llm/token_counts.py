"""Exact token counts by a prefix dynamic program.

A text is split as its byte-level tokenizer splits it; for every distinct word the program of bpe.py stores the exact
token count of every prefix, and running sums over the words give it for the prefixes of the text. Counts, budgets and
cuts are then read off, and nothing is encoded again. Map-only: no shuffle.

Cases: a null or empty text has 0 bytes and 0 tokens. The strings of added special tokens inside texts count as that one
token, as is the library's default. Repeated rows give repeated rows, and a null id is returned as null; further columns are not read; an empty table gives
an empty table. Words of any length are relaxed whole.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Merges
from .common import bounded_batches, chunks

CACHED = 600_000  # words whose counts a worker keeps


class TokenCounter:
    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.merges = Merges.byte_level(path)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        special = sorted((t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.marks = set(special)
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        #: Characters whose classes no version of Unicode changes; other texts are split by the library.
        self.plain = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-įĲ-ž‐-‧‰-⁞₠-₿]*")
        self.memory: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        """The words of a text, special tokens' strings among them as words of their own."""
        if self.special and "<|" in text:
            parts = self.special.split(text)
            return [w for k, p in enumerate(parts) for w in ([p] if k % 2 else self._split(p))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if self.plain.fullmatch(text):
            return self.words.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def learn(self, lists: list[list[str]]) -> None:
        """Counts the words that are not yet known."""
        new = list(set().union(*lists).difference(self.memory)) if lists else []
        if len(self.memory) + len(new) > CACHED:
            self.memory.clear()
            new = list(set().union(*lists))
        plain = [w for w in new if w not in self.marks]
        self.memory.update(dict.fromkeys(self.marks, 1))
        if plain:
            encoded = [w.encode() for w in plain]
            count, first = self.merges.prefix_counts(encoded)
            self.memory.update(zip(plain, count[first + [len(w) for w in encoded]].tolist(), strict=True))

    def cut(self, asked: list[tuple[str, int]]) -> list[int]:
        """For each (word, budget): the characters of its longest prefix of at most so many tokens."""
        words = [w for w, _ in asked]
        count, first = self.merges.prefix_counts([w.encode() for w in words])
        out = []
        for (w, budget), at in zip(asked, first.tolist(), strict=True):
            ends = [0, *accumulate(len(c.encode()) for c in w)] if not w.isascii() else range(len(w) + 1)
            out.append(max(k for k, e in enumerate(ends) if count[at + e] <= budget))
        return out


class PrefixIndex:
    """Token counts of every prefix of one text, without encoding again."""

    def __init__(self, counter: TokenCounter, text: str) -> None:
        self.counter, self.text, self.words = counter, text, counter.split(text)
        counter.learn([self.words])
        self.ends = [0, *accumulate(map(len, self.words))]
        self.counts = [0, *accumulate(map(counter.memory.__getitem__, self.words))]

    def count(self, chars: int) -> int:
        """Tokens of the first so many characters, as the library gives them for that prefix alone.

        Only the end is split again: a prefix may end inside a word, and how white space before it splits depends on what follows.
        """
        at = max(0, bisect_right(self.ends, chars) - 1)
        while at and (self.ends[at] >= chars or self.words[at - 1].isspace()):
            at -= 1
        tail = self.counter.split(self.text[self.ends[at] : chars])
        self.counter.learn([tail])
        return self.counts[at] + sum(map(self.counter.memory.__getitem__, tail))

    def truncate(self, budget: int) -> int:
        """Characters of the longest prefix of the text's own words and word beginnings that has at most so many tokens."""
        at = bisect_right(self.counts, budget) - 1
        if at >= len(self.words):
            return len(self.text)
        if self.words[at] in self.counter.marks:
            return self.ends[at]
        return self.ends[at] + self.counter.cut([(self.words[at], budget - self.counts[at])])[0]


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(path: str) -> TokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each text, whether these pass the limit, and the characters that fit into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            ids, column = batch.column(0).cast(pa.int64()), batch.column(1)
            for first, end, _, offsets in chunks(column, b"", 3 << 20):
                texts = [t or "" for t in column.slice(first, end - first).to_pylist()]
                lists = [counter.split(t) for t in texts]
                counter.learn(lists)
                get = counter.memory.__getitem__
                totals, fit, asked = [], [], []
                for k, words in enumerate(lists):
                    counts = list(map(get, words))
                    totals.append(sum(counts))
                    fit.append(len(texts[k]))
                    if totals[-1] > limit:
                        sums = list(accumulate(counts, initial=0))
                        at = bisect_right(sums, limit) - 1
                        fit[k] = sum(map(len, words[:at]))
                        if words[at] not in counter.marks and sums[at] < limit:
                            asked.append((k, (words[at], limit - sums[at])))
                if asked:
                    for (k, _), more in zip(asked, counter.cut([x for _, x in asked]), strict=True):
                        fit[k] += more
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(np.diff(offsets)), pa.array(totals, pa.int64()), pa.array([t > limit for t in totals]), pa.array(fit, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
                )

    bounded_batches(docs.sparkSession)
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, SCHEMA)
