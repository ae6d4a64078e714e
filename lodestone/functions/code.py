"""Expressions over code snippets: what they are, call, read and write, and what is odd about them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import packs as P
from .rules import best_class, contains_any, count_contained, count_matched, matches, matches_any, present_classes
from .text import line_count, strip


def looks_like_snippet(code: Column) -> Column:
    return contains_any(code, P.SNIPPET_MARKS)


def is_snippet(code: Column, language: Column) -> Column:
    """By fence language and, where that leaves it open, by content."""
    lang = F.lower(language)
    return F.when(lang.isin(*P.OTHER_LANGUAGES), False).when(lang.isin(*P.OWN_LANGUAGES), True).otherwise(lang.isin(*P.LIKE_LANGUAGES) & code.rlike(P.SNIPPET_PATTERN))


def joined_code(sep: str, blocks: Column, code: Column, stripped: bool = False) -> Column:
    """All code of a record: its blocks (array of strings) and its single-code column where that is not empty; as a prompt takes it, stripped."""
    if stripped:
        return strip(joined_code(sep, blocks, code))
    parts = F.transform(F.coalesce(blocks, F.array().cast("array<string>")), lambda b: F.coalesce(b, F.lit("")))
    return F.array_join(F.when(F.coalesce(code, F.lit("")) != "", F.array_append(parts, code)).otherwise(parts), sep)


def calls(code: Column) -> Column:
    """Names called, sorted and distinct: no attribute access, no keywords; casts in lower case; other names if they begin in lower case."""
    found = F.regexp_extract_all(code, F.lit(r"(?<![.@#])\b([a-zA-Z_]\w*)\s*\("), F.lit(1))
    found = F.filter(found, lambda f: ~F.lower(f).isin(*P.NOT_CALLS))
    found = F.transform(found, lambda f: F.when(F.lower(f).isin(*P.CASTS), F.lower(f)).otherwise(f))
    return F.array_sort(F.array_distinct(F.filter(found, lambda f: f.rlike("^[a-z]") | F.lower(f).isin(*P.KNOWN_CALLS))))


def attributes(code: Column) -> dict[str, Column]:
    """Attributes written (left of an equals sign) and only read, and channels in order."""
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_distinct(F.coalesce(F.regexp_extract_all(code, F.lit(r"@(\w+)"), F.lit(1)), none)))
    written = F.array_sort(F.array_distinct(F.coalesce(F.regexp_extract_all(code, F.lit(r"@(\w+)\s*="), F.lit(1)), none)))
    channels = F.regexp_extract_all(code, F.lit(r"""(?:ch[fivs]|chramp)\s*\(\s*["']([^"']+)["']"""), F.lit(1))
    return {"read": F.array_except(every, written), "written": written, "channels": channels}


def plain_attributes(names: Column) -> Column:
    """Names without leading at-signs, none empty, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda a: F.regexp_replace(a, "^@+", "")), lambda a: a != "")))


def size_complexity(code: Column, n_calls: Column) -> Column:
    lines = line_count(strip(code))
    return F.when((lines <= 2) & (n_calls <= 2), "simple").when((lines <= 8) & (n_calls <= 5), "moderate").otherwise("complex")


def difficulty_of_number(n: Column) -> Column:
    return F.when(n <= 2, "beginner").when(n <= 4, "intermediate").when(n <= 7, "advanced").otherwise("expert")


def difficulty_of_word(word: Column) -> Column:
    w = F.lower(strip(word))
    known = F.create_map(*[F.lit(x) for k, v in P.DIFFICULTY_WORDS.items() for x in (k, v)])
    return F.when(w.isin(*P.DIFFICULTIES), w).otherwise(F.coalesce(F.element_at(known, w), F.lit("beginner")))


def complexity_of_word(word: Column) -> Column:
    known = F.create_map(*[F.lit(x) for k, v in P.COMPLEXITY_WORDS.items() for x in (k, v)])
    return F.coalesce(F.element_at(known, F.lower(strip(word))), word)


def context_of_word(word: Column) -> Column:
    known = F.create_map(*[F.lit(x) for k, v in P.CONTEXT_WORDS.items() for x in (k, v)])
    return F.array(F.coalesce(F.element_at(known, F.lower(strip(F.coalesce(word, F.lit(""))))), F.lit("sop")))


def typed_text(content: Column, title: Column) -> Column:
    """What content_type() reads."""
    return F.lower(F.concat(content, F.lit(" "), title))


def content_type(content: Column, title: Column, has_code: Column, official: Column, text: Column | None = None) -> Column:
    """reference, troubleshooting, pattern, discussion or concept, in that order of precedence.

    text: typed_text() as a column of a projection before, so that it is not made anew for every rule.
    """
    text = typed_text(content, title) if text is None else text
    return (
        F.when(official | matches_any(text, P.REFERENCE_SIGNALS), "reference")
        .when(count_matched(text, P.TROUBLE_SIGNALS) >= 2, "troubleshooting")
        .when(has_code & matches_any(text, P.PATTERN_SIGNALS), "pattern")
        .when(count_matched(text, P.DISCUSSION_SIGNALS) >= 2, "discussion")
        .when(matches_any(text, P.CONCEPT_SIGNALS), "concept")
        .when(has_code & (F.length(content) < 100), "pattern")
        .otherwise("concept")
    )


def leveled_text(code: Column, text: Column) -> Column:
    """What difficulty() reads."""
    return F.lower(F.concat(code, F.lit(" "), text))


def difficulty(code: Column, text: Column, both: Column | None = None) -> Column:
    """both: leveled_text() as a column of a projection before."""
    both = leveled_text(code, text) if both is None else both
    advanced, middle = count_contained(both, P.ADVANCED_SIGNALS), count_contained(both, P.INTERMEDIATE_SIGNALS)
    lines = F.when(code != "", line_count(strip(code))).otherwise(0)
    return (
        F.when(contains_any(both, P.EXPERT_SIGNALS), "expert")
        .when(advanced >= 2, "advanced")
        .when((middle >= 2) | (advanced >= 1), "intermediate")
        .when(lines > 20, "advanced")
        .when(lines > 8, "intermediate")
        .otherwise("beginner")
    )


def local_difficulty(text: Column, code: Column) -> Column:
    both = F.lower(F.concat(text, F.lit(" "), code))
    return F.when(contains_any(both, P.LOCAL_ADVANCED), "advanced").when(contains_any(both, P.LOCAL_INTERMEDIATE), "intermediate").otherwise("beginner")


def contexts(code: Column) -> Column:
    """Execution contexts, sorted; null if no signal is present. One context alone is joined by sop where that has signals too."""
    found = present_classes(code, P.CONTEXT_SIGNALS)
    both = F.when((F.size(found) == 1) & contains_any(code, P.SOP_SIGNALS), F.array_append(found, F.lit("sop"))).otherwise(found)
    return F.when(F.size(found) > 0, F.array_sort(both))


def local_contexts(code: Column) -> Column:
    found = F.array_compact(F.array(*[F.when(contains_any(code, signals), F.lit(c)) for c, signals in P.LOCAL_CONTEXTS]))
    return F.when(F.size(found) > 0, F.array_sort(F.array_distinct(found))).otherwise(F.array(F.lit("sop")))


def version(code: Column) -> tuple[Column, Column]:
    """The highest version that a rule asks for (empty if none does), and the notes of all that do."""
    hits = F.array_compact(F.array(*[F.when(matches(code, p), F.struct(F.lit(v).alias("v"), F.lit(n).alias("n"))) for p, v, n in P.VERSION_RULES]))
    return F.coalesce(F.array_max(F.transform(hits, lambda h: h["v"])), F.lit("")), F.array_join(F.transform(hits, lambda h: h["n"]), "; ")


def topic(code: Column) -> Column:
    """The topic with most indicators; mathematics if none is present; empty for snippets of under 10 characters."""
    return F.when(F.length(code) < 10, "").otherwise(F.coalesce(best_class(code, P.TOPIC_SIGNALS), F.lit("math_operations")))


def normal_topic(name: Column) -> Column:
    """A known name's topic, else that of the part before a comma, else the name with underscores for spaces."""
    known = F.create_map(*[F.lit(x) for k, v in P.TOPIC_NAMES.items() for x in (k, v)])
    whole = strip(name)
    first = F.when(F.contains(whole, F.lit(",")), strip(F.element_at(F.split(whole, ",", -1), 1))).otherwise(whole)
    spaced = F.when(F.contains(first, F.lit(" ")), F.replace(F.lower(first), F.lit(" "), F.lit("_"))).otherwise(first)
    return F.coalesce(F.element_at(known, F.lower(whole)), F.element_at(known, F.lower(first)), spaced)


def balance(code: Column, a: str, b: str) -> Column:
    """How many more of one sign than of another."""
    return F.length(F.replace(code, F.lit(b), F.lit(""))) - F.length(F.replace(code, F.lit(a), F.lit("")))


def warnings(code: Column) -> Column:
    """What is odd about a snippet, in order: lines that lack a semicolon, balance, deprecated syntax, leaks, read-only attributes."""
    lines = F.split(strip(code), "\n", -1)

    def line(text: Column, i: Column) -> Column:
        s = strip(text)
        fine = (s == "") | s.rlike(r"[;{},(\\:]$") | s.rlike(r"^(?://|#|/\*|\*)") | s.endswith("*/") | ~F.contains(s, F.lit("="))
        return F.when(~fine, F.concat(F.lit("Line "), (i + 1).cast("string"), F.lit(": possible missing semicolon: "), F.substring(s, 1, 60)))

    def uneven(a: str, b: str, name: str) -> Column:
        n = balance(code, a, b)
        more = F.concat(F.lit(f"Unclosed {name}: "), n.cast("string"), F.lit(f" more {a} than {b}"))
        less = F.concat(F.lit(f"Extra closing {name}: "), (-n).cast("string"), F.lit(f" more {b} than {a}"))
        return F.when(n > 0, more).when(n < 0, less)

    rest = [uneven("{", "}", "braces"), uneven("(", ")", "parentheses")]
    rest += [F.when(code.rlike(p), m) for p, m in P.DEPRECATED]
    rest += [F.when(F.contains(code, F.lit("pcopen")) & ~F.contains(code, F.lit("pcclose")), "pcopen() called without pcclose() -- potential resource leak")]
    rest += [F.when(code.rlike(rf"@{a}\s*="), f"Assigning to @{a} -- this is a read-only attribute") for a in P.READ_ONLY]
    return F.concat(F.array_compact(F.transform(lines, line)), F.array_compact(F.array(*rest)))


def add_absent(old: Column, new: Column) -> Column:
    """Old items, then those new ones that are not among them."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(old, none), F.filter(F.coalesce(new, none), lambda x: ~F.array_contains(F.coalesce(old, none), x)))


def snippet_context(code: Column) -> Column:
    """point, prim, vertex, detail or unknown, by the attributes and setters in a snippet (the default of the context task)."""
    point = contains_any(code, ["@ptnum", "setpointattrib"])
    prim = contains_any(code, ["@primnum", "primpoints", "setprimattrib"])
    vertex = contains_any(code, ["@vtxnum", "setvertexattrib"])
    several = point.cast("int") + prim.cast("int") + vertex.cast("int")
    detail = F.contains(code, F.lit("setdetailattrib")) & ~code.rlike(r"\b(?:for|foreach|while)\b")
    return F.when(several > 1, "unknown").when(point, "point").when(prim, "prim").when(vertex, "vertex").when(detail, "detail").when(contains_any(code, ["@P", "@N", "@Cd"]), "point").otherwise("unknown")
