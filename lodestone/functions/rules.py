"""A small rule compiler: tables of signals become one column expression each, so whole-stage code runs them in one pass."""

from __future__ import annotations

import re
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(text: Column, signals: list[str]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(s)) for s in signals), F.lit(False))


def count_contained(text: Column, signals: list[str]) -> Column:
    return reduce(add, (F.contains(text, F.lit(s)).cast("int") for s in signals), F.lit(0))


def literals(pattern: str) -> list[str]:
    """Words that every match of a pattern holds (of patterns in which letters stand for themselves); none where it has alternatives."""
    bare, last = pattern, None
    while bare != last:  # groups may be optional or hold alternatives
        last, bare = bare, re.sub(r"\((?:\?[:i]\)?)?[^()]*\)[?*]?", " ", bare)
    if "|" in bare:
        return []
    bare = re.sub(r"\\.|\[[^\]]*\]", " ", bare)
    return re.findall(r"[A-Za-z_]{3,}", re.sub(r"\w[?*]", " ", bare))


def matches(text: Column, pattern: str, lowered: Column | None = None) -> Column:
    """Whether a pattern occurs; plain searches for its words go before, as most texts lack them. lowered: the text in lower case, for patterns without case."""
    plain = text if lowered is None else lowered
    words = literals(pattern.removeprefix("(?i)"))
    return reduce(and_, [F.contains(plain, F.lit(w if lowered is None else w.lower())) for w in words] + [text.rlike(pattern)])


def matches_any(text: Column, patterns: list[str]) -> Column:
    return reduce(or_, (matches(text, p) for p in patterns), F.lit(False))


def count_matched(text: Column, patterns: list[str]) -> Column:
    return reduce(add, (matches(text, p).cast("int") for p in patterns), F.lit(0))


def best_class(text: Column, table: dict[str, list[str]]) -> Column:
    """The class with most signals present, the earlier one on ties; null if none is present."""
    scored = F.array(*[F.struct(count_contained(text, s).alias("n"), F.lit(-k).alias("o"), F.lit(c).alias("c")) for k, (c, s) in enumerate(table.items())])
    best = F.array_max(scored)
    return F.when(best["n"] > 0, best["c"])


def present_classes(text: Column, table: dict[str, list[str]]) -> Column:
    """All classes with a signal present, in the order of the table."""
    return F.array_compact(F.array(*[F.when(contains_any(text, s), F.lit(c)) for c, s in table.items()]))
