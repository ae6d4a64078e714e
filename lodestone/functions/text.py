"""Text expressions: JVM-side columns that behave as the usual scripting-language string methods do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import packs as P


def strip(text: Column) -> Column:
    """Without white space at both ends (Unicode)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Words between white space (Unicode), none empty."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def shingles(tokens: Column, n: int = 3, single_under: int = 10) -> Column:
    """Distinct n-word shingles; texts of under single_under words also give their single words.

    The words are bound as a lambda's variable: a pushed-down filter would otherwise write their expression into the
    inner lambda, and they would be split again for every shingle.
    """

    def of(w: Column) -> Column:
        size = F.size(w)

        # element by element: slice() would copy the whole array for every shingle
        def gram(i: Column) -> Column:
            return F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)])

        grams = F.when(size >= n, F.transform(F.sequence(F.lit(0), F.greatest(size - n, F.lit(0))), gram)).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.when(size < single_under, F.concat(grams, w)).otherwise(grams))

    return F.element_at(F.transform(F.array(tokens), of), 1)


def search_tokens(text: Column) -> Column:
    """Index terms: lower-case runs of letters, digits and underscores, also behind an @; single letters only behind an @. A null text has none."""
    found = F.regexp_extract_all(F.coalesce(F.lower(text), F.lit("")), F.lit(r"@?[\p{L}\p{N}_]+"), F.lit(0))
    return F.filter(found, lambda t: (F.length(t) > 1) | t.startswith("@"))


def join_nonempty(sep: str, *parts: Column) -> Column:
    """Parts that are neither null nor empty, joined."""
    return F.concat_ws(sep, *[F.nullif(p, F.lit("")) for p in parts])


def first_sentence(text: Column, most: int = 200) -> Column:
    """Up to the first full stop followed by a space, without closing stops, capped, with one stop."""
    head = F.regexp_replace(F.element_at(F.split(text, r"\. ", -1), 1), r"\.+$", "")
    return F.concat(F.when(F.length(head) > most, F.concat(F.substring(head, 1, most - 3), F.lit("..."))).otherwise(head), F.lit("."))


def truncate_lines(text: Column, most: int = 30, mark: str = "// ...") -> Column:
    """The first lines of a text, marked if it had more; closing line feeds do not count."""
    lines = F.split(F.regexp_replace(text, r"\n+$", ""), "\n", -1)
    return F.when(F.size(lines) > most, F.concat(F.array_join(F.slice(lines, 1, most), "\n"), F.lit("\n" + mark))).otherwise(F.array_join(lines, "\n"))


def pretty_label(key: Column) -> Column:
    """Underscores as spaces, each run of letters capitalised."""
    spaced = F.lower(F.translate(key, "_", " "))
    parts = F.regexp_extract_all(spaced, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def clean_heading(text: Column) -> Column:
    """Without pilcrows and zero-width marks, odd spaces as spaces, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(text, "[¶​-‍﻿]", ""), "[  -  ]", " "))


def section_label(page: Column) -> Column:
    """A wiki page's label: the day of a numbered page, a fixed name, or the page's own."""
    day = F.regexp_extract(page, P.DAY_PAGE, 1)
    return F.when(page.isin(*P.PAGE_LABELS), label_of(page, P.PAGE_LABELS)).when(day != "", F.concat(F.lit(P.DAY_LABEL), day.try_cast("int").cast("string"))).otherwise(page)


def page_difficulty(page: Column) -> Column:
    """By the day of a numbered page; others are for beginners, but for some."""
    day = F.regexp_extract(page, P.DAY_PAGE, 1)
    return F.when(page.isin(*P.MIDDLE_PAGES), "intermediate").when(day == "", "beginner").otherwise(number_difficulty(day.try_cast("int")))


def number_difficulty(number: Column) -> Column:
    return F.when(number <= 5, "beginner").when(number <= 13, "intermediate").otherwise("advanced")


def episode(ident: Column) -> Column:
    """The episode number anywhere in an id; null if there is none."""
    return F.nullif(F.regexp_extract(ident, r"ep(\d+)", 1), F.lit("")).try_cast("int")


def return_type(signature: Column) -> Column:
    """The type before a function's name; empty if there is none."""
    return F.regexp_extract(signature, r"^(\w+(?:\[\])?)\s+\w+\s*\(", 1)


def preview(text: Column, most: int = 200) -> Column:
    return F.substring(text, 1, most)


def label_of(key: Column, labels: dict[str, str]) -> Column:
    """The label of a key, or the key itself."""
    known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.element_at(known, key), key)


def searchable(title: Column, content: Column, codes: Column, code: Column, prompt: Column, explanation: Column) -> Column:
    """What an index reads of a record: its parts that are not empty, one below the other."""
    blocks = F.array_join(F.filter(F.coalesce(codes, F.array().cast("array<string>")), lambda c: F.coalesce(c, F.lit("")) != ""), "\n")
    return join_nonempty("\n", title, content, blocks, code, prompt, explanation)


def comparable(content: Column, codes: Column, code: Column | None = None) -> Column:
    """What duplicates are judged by: content and code in lower case, joined by spaces."""
    blocks = F.array_join(F.coalesce(codes, F.array().cast("array<string>")), " ")
    return strip(F.lower(join_nonempty(" ", content, blocks, code if code is not None else F.lit(""))))


def line_feeds(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def line_count(text: Column) -> Column:
    return line_feeds(text) + 1


def sequence_id(prefix: Column, number: Column, digits: int = 3) -> Column:
    return F.concat(prefix, F.lit("_"), F.format_string(f"%0{digits}d", number))


def unfence(text: Column) -> Column:
    """The body of the first fenced block marked json, else of the first fenced block, else the text."""
    tagged = F.regexp_extract(text, r"(?s)```json(.*?)(?:```|$)", 1)
    plain = F.regexp_extract(text, r"(?s)```(.*?)(?:```|$)", 1)
    return strip(F.when(F.contains(text, F.lit("```json")), tagged).when(F.contains(text, F.lit("```")), plain).otherwise(text))


def strip_tags(html: Column) -> Column:
    """The text of markup: scripts and styles out, tags as spaces, the common entities read, white space folded."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    for entity, letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(letter))
    return F.trim(F.regexp_replace(bare, r"[ \t\n\r\f]+", " "))
