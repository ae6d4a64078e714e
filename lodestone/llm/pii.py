"""Personal data by DataFrame functions alone.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod 97 for account numbers, ranges for
addresses, digit counts for phones), and words near a span raise or lower its score; spans under THRESHOLD are dropped.
The four base kinds are kept whenever their validator holds. Map-only: no shuffle, no Python on the executors.

The expressions are possessive and anchored at the starts of runs, which finds the same spans as the plain ones but
in time linear in the text, also on long runs of digits or letters. Positions come from two readings of one pattern: the
matches, and the pieces between them; their lengths are summed in runs (running()), and context words and masked texts are
cut from short parts, so the work for each span does not grow with the text, up to some 10^7 spans.

Cases: a null or empty text has no span. Positions are code points, end exclusive. Kinds may overlap one another; spans of
one kind do not. Each row is judged alone, so repeated rows, ties and further columns (read by no expression but kept by
the callers that ask) are no concern. A null id is returned as it is. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
NEAR = 40  # characters before a span that are searched for context words
LEAST = 3  # characters that any match has at least
CUT = 1024  # characters of a part of a text
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a cheap expression that texts with a match satisfy
    prior: float
    confirmed: float  # added if the validator holds
    context: str  # words that add NEARBY
    base: bool = False


NEARBY, CHILLING = 0.3, -0.3
#: Words before a number that speak against personal data.
COUNTER = r"(?i)\b(?:isbn|issn|version|sku|order no|page)\b"

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.6, 0.2, r"(?i)\b(?:e-?mail|contact|write|mailto)\b", True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", ".", 0.5, 0.2, r"(?i)\b(?:ip|address|host|server|client)\b", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12,}+", "", 0.4, 0.4, r"(?i)\b(?:card|visa|credit|debit|mastercard|amex)\b", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.5, 0.2, r"(?i)\b(?:call|phone|tel|mobile|fax|whatsapp)\b", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", 0.2, 0.5, r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b"),
    Kind("secret", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])", "", 0.3, 0.0, r"(?i)\b(?:token|key|secret|password|passwd|bearer)\b"),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    back = F.split(F.reverse(digits), "")
    doubled = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise((d.try_cast("int") * 2) % 10 + F.floor(d.try_cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, is 1 modulo 97."""
    bare = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (a * 10 + c.try_cast("int")) % 97).when(c.between("A", "Z"), (a * 100 + F.ascii(c) - 55) % 97).otherwise(a)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(match)).between(13, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


STRIDE = 256  # items of a list that are added up one by one; longer lists go by runs of these


def _bound(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _scan(values: Column, op, start: Column) -> Column:
    """What came before each item of a short list of integers, by op from a start on."""
    zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, zero, lambda a, v: F.struct(op(a["at"], v).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))["out"]


def running(values: Column, op, levels: int = 2) -> Column:
    """What came before each item of a list of integers, 0 before the first. op: associative, of two columns.

    An array grows by copying, so items are scanned in runs of STRIDE, and the runs' totals likewise; a list of n costs about
    n * STRIDE / 2 steps, and (n / STRIDE^2)^2 / 2 on top.
    """
    zero = F.lit(0)
    if levels == 0:
        return _scan(values, op, zero)

    def long(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRIDE).cast("int")), lambda c: F.filter(F.transform(F.sequence(F.lit(0), F.lit(STRIDE - 1)), lambda j: F.get(v, c * STRIDE + j)), lambda x: x.isNotNull()))

        def over(r: Column) -> Column:
            totals = F.transform(r, lambda run: F.aggregate(run, zero, op))
            return F.flatten(F.zip_with(r, running(totals, op, levels - 1), lambda run, before: _scan(run, op, before)))

        return _bound(runs, over)

    return _bound(values, lambda v: F.when(F.size(v) <= STRIDE, _scan(v, op, zero)).otherwise(long(v)))


def _spans(kind: Kind, text: Column, matches: Column) -> Column:
    """The spans of one kind that pass, in order."""
    pieces = F.split(text, kind.pattern, -1)
    pairs = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("match"), F.right(p, F.lit(NEAR)).alias("p"), F.right(m, F.lit(NEAR)).alias("m")))

    def placed(z: Column) -> Column:
        before = running(F.transform(z, lambda x: x["gap"] + x["size"]), lambda a, b: a + b)
        return _bound(before, lambda at: F.filter(F.transform(z, lambda x, i: scored(z, x, i, F.get(at, i) + x["gap"])), lambda s: s["score"] >= THRESHOLD))

    def scored(z: Column, x: Column, i: Column, start: Column) -> Column:
        # a match has LEAST characters or more, so NEAR characters reach over so many matches at most
        back = F.transform(F.sequence(F.greatest(i - NEAR // LEAST, F.lit(0)), i), lambda j: F.when(j == i, x["p"]).otherwise(F.concat(F.get(z, j)["p"], F.get(z, j)["m"])))
        near = F.right(F.array_join(back, ""), F.lit(NEAR))

        def score(said: Column) -> Column:
            value = (
                F.lit(kind.prior)
                + F.when(_valid(kind.name, x["match"]), kind.confirmed).otherwise(F.lit(-1.0))
                + F.when(said.rlike(kind.context), NEARBY).otherwise(F.lit(0.0))
                + F.when(said.rlike(COUNTER), 0.0 if kind.base else CHILLING).otherwise(F.lit(0.0))
            )
            return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + x["size"]).alias("end"), F.round(F.least(F.lit(1.0), value), 3).alias("score"))

        return _bound(near, score)

    return _bound(pairs, placed)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """The frame with a column of all spans: by kind as listed, then by start."""
    text = F.coalesce(docs[text_col], F.lit(""))
    none = F.array().cast(SPANS)
    hits = {}
    for k in KINDS:
        found = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        hits[k.name] = F.when(F.contains(text, F.lit(k.hint)), found) if k.hint else found
    marked = docs.withColumn("__matches", F.struct(*[c.alias(k) for k, c in hits.items()]))
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_kind = [F.when(F.size(F.col("__matches")[k.name]) > 0, _spans(k, text, F.col("__matches")[k.name])).otherwise(none) for k in KINDS]
    return marked.withColumn(out, F.concat(*by_kind)).drop("__matches")


def mask(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind in brackets."""

    def cut(parts: Column, start: Column, end: Column) -> Column:
        # from the parts that hold it, as reaching into a text takes time up to the place
        held = F.transform(F.sequence(F.floor(start / CUT).cast("int"), F.floor((end - 1) / CUT).cast("int")), lambda c: F.substring(F.get(parts, c), F.greatest(start - c * CUT, F.lit(0)) + 1, F.least(end - c * CUT, F.lit(CUT)) - F.greatest(start - c * CUT, F.lit(0))))
        return F.when(end > start, F.array_join(held, "")).otherwise("")

    def masked(parts: Column, ordered: Column, before: Column) -> Column:
        pieces = F.transform(ordered, lambda s, i: F.when(s["start"] >= F.get(before, i), F.concat(cut(parts, F.get(before, i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        last = F.greatest(F.element_at(before, -1), F.element_at(ordered, -1)["end"])
        return F.concat(F.array_join(F.array_compact(pieces), ""), _bound(last, lambda at: cut(parts, at, F.length(text))))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    parts = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CUT}}}"), F.lit(0))
    whole = _bound(parts, lambda c: _bound(ordered, lambda o: _bound(running(F.transform(o, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), lambda e: masked(c, o, e))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and checksums of the spans of each text."""
    found = find_pii(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("pii", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("pii")).alias("spans"))
