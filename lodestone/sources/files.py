"""Readers: code files, markdown, JSON lines, JSON trees, snapshots, and their union in a fixed order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import code as C
from ..functions import text as T
from ..functions.identity import derived_id, hash16

CODE_SUFFIXES, TEXT_SUFFIXES = ("vex", "vfl", "h"), ("md", "txt")
ANCHORED, LOOSE = r"(?ms)^```(\w*)\n(.*?)^```", r"(?s)```((?:vex|c\+\+|cpp)?)\n(.*?)```"  # fences
CODE_KEYS = ("code", "vex", "vex_code", "snippet")


def whole_files(spark: SparkSession, path: str, suffixes: tuple[str, ...], recursive: bool = True) -> DataFrame:
    """path, text of files with one of the suffixes; corrupt ones are left out."""
    reader = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").option("ignoreCorruptFiles", True)
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def code_files(spark: SparkSession, path: str) -> DataFrame:
    """A sample of each code file, stripped."""
    df = whole_files(spark, path, CODE_SUFFIXES)
    return df.select(F.lit(1).alias("source_line"), "path", T.strip(F.col("text")).alias("code")).where("code <> ''")


def fenced_blocks(text: Column, anchored: bool = True) -> Column:
    """array<struct<language, code>> of fenced blocks. Not anchored: fences of snippets anywhere in a line, as older data was read."""
    pattern = ANCHORED if anchored else LOOSE
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("language"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("code"))


def fence_samples(files: DataFrame, anchored: bool = False) -> DataFrame:
    """path, source_line, code of fenced snippets in text files (path, text); the line is that of the opening fence."""
    pattern = ANCHORED if anchored else LOOSE
    # the pieces between matches tell where each match begins
    pieces = F.transform(F.split("text", pattern, -1), T.line_feeds)
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    blocks = files.select("path", F.posexplode(F.arrays_zip(fenced_blocks(F.col("text"), anchored).alias("b"), whole.alias("w"))).alias("n", "z"), pieces.alias("gaps"), F.transform(whole, T.line_feeds).alias("sizes"))
    before = F.aggregate(F.slice("gaps", 1, F.col("n") + 1), F.lit(0), lambda a, x: a + x) + F.aggregate(F.slice("sizes", 1, F.col("n")), F.lit(0), lambda a, x: a + x)
    out = blocks.select("path", (before + 1).alias("source_line"), T.strip(F.col("z.b.code")).alias("code"))
    return out.where(C.looks_like_snippet(F.col("code")))


def json_lines(spark: SparkSession, path: str, column: str = "v") -> DataFrame:
    """Parsed lines as VARIANT; blank and malformed lines are left out."""
    return spark.read.text(path).where(T.strip(F.col("value")) != "").select(F.try_parse_json("value").alias(column)).where(F.col(column).isNotNull())


def json_values(df: DataFrame, json_col: str, fields: dict[str, str]) -> DataFrame:
    """Fields (name: type) of a column of JSON text; null where the text is malformed or the value of another type."""
    v = F.try_parse_json(json_col)
    return df.select(*[F.try_variant_get(v, f"$.{name}", kind).alias(name) for name, kind in fields.items()])


def typed_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_strings(df: DataFrame, json_col: str, keys: tuple[str, ...] = CODE_KEYS) -> DataFrame:
    """The rows with id, key, value of every string below one of the keys in a JSON tree of any depth, in document order; such keys are not entered.

    id is the string of that name beside it, or empty. Only the JSON itself passes through Arrow; a tree is walked with a
    stack of its own, so its depth is no concern. Malformed JSON gives nothing.
    """
    import json

    wanted = set(keys)

    def walk(text: str | None) -> list[dict[str, str]]:
        try:
            stack = [json.loads(text)] if text else []
        except (ValueError, RecursionError):
            return []
        out = []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                out.append(dict(zip(("id", "key", "value"), node, strict=True)))
            elif isinstance(node, dict):
                own = node.get("id", "")
                parts = [(own if isinstance(own, str) else str(own), k, v) if k in wanted and isinstance(v, str) else v for k, v in node.items()]
                stack.extend(x for x in reversed(parts) if isinstance(x, (dict, list, tuple)))
            elif isinstance(node, list):
                stack.extend(x for x in reversed(node) if isinstance(x, (dict, list)))
        return out

    @F.pandas_udf("array<struct<id:string,key:string,value:string>>")
    def found(trees: pd.Series) -> pd.Series:
        return trees.map(walk)

    return df.select("*", F.posexplode(found(F.col(json_col))).alias("place", "found")).select(*df.columns, "place", "found.id", "found.key", "found.value")


def json_samples(spark: SparkSession, path: str) -> DataFrame:
    """path, place, id, code of the snippets in a folder's JSON files."""
    found = json_strings(whole_files(spark, path, ("json",)), "text")
    return found.where(C.looks_like_snippet(F.col("value"))).select("path", "place", "id", T.strip(F.col("value")).alias("code"))


def ingest(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """path, source_line, place, id, code: the samples of a folder's code, text and JSON files, ids derived where there is none, the first of each hash."""
    from ..operators.dedup import first_wins

    texts = whole_files(spark, path, TEXT_SUFFIXES, recursive)
    every = [code_files(spark, path).select("path", "source_line", F.lit(0).alias("place"), F.lit("").alias("id"), "code")]
    every.append(fence_samples(texts).select("path", "source_line", F.col("source_line").alias("place"), F.lit("").alias("id"), "code"))
    every.append(json_samples(spark, path).select("path", F.lit(0).alias("source_line"), "place", "id", "code"))
    rows = every[0].unionByName(every[1]).unionByName(every[2]).withColumn("hash", hash16(F.col("code")))
    return first_wins(rows, F.col("hash"), [F.col("path"), F.col("place")]).withColumn("id", derived_id(F.col("id"), F.col("code")))


def samples(codes: DataFrame) -> DataFrame:
    """Codes with hash and id, the first of each hash."""
    from ..operators.dedup import first_wins

    marked = codes.withColumns({"hash": hash16(F.col("code")), "id": derived_id(F.lit(""), F.col("code"))})
    return first_wins(marked, F.col("hash"), [F.col("path"), F.col("source_line")])


def literal(spark: SparkSession, code: str, source: str) -> DataFrame:
    return spark.createDataFrame([(code, source, 1)], "code string, path string, source_line int")


def union_in_order(*sources: DataFrame) -> DataFrame:
    """All sources with src_ord; missing columns are null. Row order within a source must be a column of its own."""
    out = None
    for k, df in enumerate(sources):
        df = df.withColumn("src_ord", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def preferred_files(names: list[str]) -> list[str]:
    """Of a folder's JSON-lines files the first combined one in name order, else all."""
    every = sorted(n for n in names if n.endswith(".jsonl"))
    combined = [n for n in every if n.endswith("_all.jsonl")]
    return combined[:1] or every


def markdown_sections(files: DataFrame, legacy: bool = False) -> DataFrame:
    """path, seq, heading, body: sections between headings of levels 1 to 4, the preamble under the file's name; empty ones are left out.

    Headings inside fences do not count, unless legacy.
    """
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    marked = F.col("text") if legacy else _masked(F.col("text"))
    parts = F.split(marked, r"(?m)(?=^#{1,4}\s+\S)", -1)
    rows = files.select("path", name.alias("name"), F.posexplode(parts).alias("pos", "part"))
    head = F.regexp_extract("part", r"^#{1,4}\s+(.+)", 1)
    body = F.when(head != "", F.regexp_replace("part", r"^#{1,4}\s+.+", "")).otherwise(F.col("part"))
    body = body if legacy else F.replace(body, F.lit("\u0001"), F.lit("#"))
    kept = rows.select("path", "name", "pos", F.when(head != "", T.strip(head)).otherwise(F.col("name")).alias("heading"), T.strip(body).alias("body")).where("body <> ''")
    seq = F.row_number().over(Window.partitionBy("path").orderBy("pos"))
    return kept.withColumn("seq", seq).select("path", "name", "seq", "heading", "body")


def _masked(text: Column) -> Column:
    """The text with line-leading hashes inside fences set aside."""
    fences = F.regexp_extract_all(text, F.lit(r"(?ms)^```.*?^```"), F.lit(0))
    rest = F.split(text, r"(?ms)^```.*?^```", -1)
    safe = F.transform(fences, lambda f: F.regexp_replace(f, r"(?m)^#", "\u0001"))
    return F.array_join(F.transform(rest, lambda r, i: F.concat(r, F.coalesce(F.get(safe, i), F.lit("")))), "")


def markdown_chunks(files: DataFrame, source_id: str = "local-skill", authority: float = 0.85, legacy: bool = False) -> DataFrame:
    """Chunks of markdown files (path, text): prose without fences, snippets, difficulty, contexts; sections with neither are left out."""
    s = markdown_sections(files, legacy)
    blocks = F.filter(fenced_blocks(F.concat(F.col("body"), F.lit("\n"))), lambda b: (T.strip(b["code"]) != "") & C.is_snippet(b["code"], b["language"]))
    codes = F.transform(blocks, lambda b: T.strip(b["code"]))
    prose = F.filter(F.transform(F.split(F.col("body"), r"(?ms)^```\w*\n.*?^```", -1), lambda p: T.strip(p)), lambda p: p != "")
    rows = s.select("path", "name", "seq", "heading", codes.alias("codes"), F.array_join(prose, "\n\n").alias("content")).where("content <> '' or size(codes) > 0")
    code = F.array_join("codes", " ")
    return rows.select(
        T.sequence_id(F.concat(F.lit(f"local_{source_id}_"), F.lower("name")), F.col("seq")).alias("id"), "content", "codes", F.when(F.size("codes") > 0, "pattern").otherwise("concept").alias("content_type"),
        C.local_difficulty(F.col("content"), code).alias("difficulty"), C.local_contexts(code).alias("vex_context"), F.lit(source_id).alias("source_id"), F.col("path").alias("source_url"),
        F.lit(authority).alias("source_authority"), F.col("heading").alias("title"), F.col("name").alias("section"),
    )


def directory(spark: SparkSession, path: str, exclude: tuple[str, ...] = ("CLAUDE.md", "LICENSE.md", "CHANGELOG.md")) -> DataFrame:
    """Markdown files below a folder, but for the excluded names."""
    return whole_files(spark, path, ("md",)).where(~F.regexp_extract("path", r"([^/]+)$", 1).isin(*exclude))


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Samples of snapshot files ({"samples": [...]}) as JSON text, first of each id; corrupt files are left out."""
    from ..operators.dedup import first_wins

    files = whole_files(spark, path, ("json",)).select("path", F.try_parse_json("text").alias("v")).where("v is not null")
    rows = files.select("path", F.posexplode(F.try_variant_get("v", "$.samples", "array<variant>")).alias("pos", "s"))
    named = rows.select("path", "pos", F.coalesce(F.try_variant_get("s", "$.id", "string"), F.lit("")).alias("id"), F.to_json("s").alias("value"))
    return first_wins(named, F.col("id"), [F.col("path"), F.col("pos")])
