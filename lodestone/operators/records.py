"""The canonical record: schema, migration from the older shape, tagging and repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import code as C
from ..functions import packs as P
from ..functions.identity import checksum, derived_id
from ..functions.text import strip

PIPELINE_VERSION = "0.2.0"

CHUNK_SCHEMA = """
id STRING, content STRING, code_blocks ARRAY<STRUCT<code:STRING,line_context:STRING,is_complete:BOOLEAN>>, content_type STRING, difficulty STRING,
vex_context ARRAY<STRING>, source_id STRING, source_url STRING, source_authority DOUBLE, title STRING, section STRING, functions_referenced ARRAY<STRING>,
attributes_read ARRAY<STRING>, attributes_written ARRAY<STRING>, houdini_version_min STRING, houdini_version_notes STRING, prerequisites ARRAY<STRING>,
created_at STRING, pipeline_version STRING, checksum STRING, prompt STRING, alternative_prompts ARRAY<STRING>, explanation STRING,
flagged_for_review BOOLEAN, review_reason STRING, validation_warnings ARRAY<STRING>,
llm_topic STRING, llm_secondary_topics ARRAY<STRING>, llm_bugs ARRAY<STRUCT<type:STRING,severity:STRING,location:STRING,description:STRING,suggestion:STRING>>,
llm_code_quality STRING, llm_complexity STRING, llm_bottlenecks ARRAY<STRING>, llm_key_concepts ARRAY<STRING>, code STRING
"""


def chunk_schema() -> StructType:
    return StructType.fromDDL(" ".join(CHUNK_SCHEMA.split()))


def conform(df: DataFrame) -> DataFrame:
    """Every column of the schema in order; columns that are absent are null (never processed)."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in chunk_schema()])


def migrate(raw: DataFrame, json_col: str = "value") -> DataFrame:
    """Records of the older shape, nested or flat, from a column of JSON text; malformed lines are left out.

    The nested value goes before the flat one, the default comes last. Numbers and words are both difficulties.
    """
    v = F.col("v")
    text = lambda *paths: F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths], F.lit(""))
    items = lambda *paths: F.coalesce(*[F.try_variant_get(v, p, "array<variant>") for p in paths], F.array().cast("array<variant>"))
    name = lambda x: F.coalesce(F.try_variant_get(x, "$.name", "string"), F.try_variant_get(x, "$", "string"))
    names = lambda *paths: F.transform(items(*paths), name)
    parsed = raw.select(F.try_parse_json(json_col).alias("v")).where("v is not null")
    difficulty_v = F.coalesce(F.try_variant_get(v, "$.generation.difficulty", "variant"), F.try_variant_get(v, "$.difficulty", "variant"))
    kind = F.schema_of_variant(difficulty_v)
    number = F.try_variant_get(difficulty_v, "$", "int")
    level = F.when(kind.isin("BIGINT", "INT") & (number > 0), C.difficulty_of_number(number)).when(kind == "STRING", C.difficulty_of_word(F.try_variant_get(difficulty_v, "$", "string"))).otherwise("beginner")
    code, source = text("$.code"), text("$.source_file")
    video = F.contains(source, F.lit("youtube.com"))
    prompt, explanation = text("$.generation.prompt", "$.prompt"), text("$.generation.explanation", "$.explanation")
    ident = text("$.id")
    episode = F.regexp_extract(ident, r"^joy_of_vex_ep(\d+)", 1)
    out = parsed.select(
        ident.alias("id"),
        explanation.alias("content"),
        F.when(code != "", F.array(F.struct(code.alias("code"), F.lit("").alias("line_context"), F.lit(True).alias("is_complete")))).otherwise(F.array().cast("array<struct<code:string,line_context:string,is_complete:boolean>>")).alias("code_blocks"),
        F.lit("concept").alias("content_type"),
        level.alias("difficulty"),
        C.context_of_word(text("$.classification.context", "$.context")).alias("vex_context"),
        F.when(video, "joy-of-vex-youtube").otherwise("").alias("source_id"),
        source.alias("source_url"),
        F.when(video, 0.9).otherwise(0.0).alias("source_authority"),
        prompt.alias("title"),
        F.when(episode != "", F.concat(F.lit("Joy of VEX Day "), episode.try_cast("int").cast("string"))).otherwise("").alias("section"),
        names("$.classification.functions", "$.functions").alias("functions_referenced"),
        C.plain_attributes(names("$.classification.attributes_read", "$.attributes_read")).alias("attributes_read"),
        C.plain_attributes(names("$.classification.attributes_written", "$.attributes_written")).alias("attributes_written"),
        text("$.created_at").alias("created_at"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        prompt.alias("prompt"),
        names("$.generation.alternative_prompts", "$.alternative_prompts").alias("alternative_prompts"),
        explanation.alias("explanation"),
        F.coalesce(F.try_variant_get(v, "$.quality.flagged_for_review", "boolean"), F.try_variant_get(v, "$.flagged_for_review", "boolean"), F.lit(False)).alias("flagged_for_review"),
        text("$.quality.review_reason", "$.review_reason").alias("review_reason"),
    )
    return conform(out.withColumn("checksum", checksum(F.col("content"), F.transform("code_blocks", lambda b: b["code"]))))


#: The fields of an upstream record.
UPSTREAM = """
id STRING, code STRING, difficulty STRING, vex_functions ARRAY<STRING>, vex_context STRING, ocr_confidence DOUBLE, category STRING, topic STRING, related_concepts ARRAY<STRING>,
explanation STRING, needs_review BOOLEAN, youtube_url STRING, source STRING
"""


def import_records(raw: DataFrame) -> DataFrame:
    """Samples of upstream records (the columns of UPSTREAM that there are, and ord): code without blank ends, empty code out, first by ord of each code's hash; with what the code
    reads, writes and how complex it is, difficulty as a number, and the record's own words as prompt, topic and explanation. An absent column is one of nulls.
    """
    from ..functions.identity import hash16
    from .dedup import first_wins

    given = {f.name: (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(" ".join(UPSTREAM.split()))}
    kept = raw.select("ord", *given.values()).withColumn("code", strip(F.col("code"))).where("code <> ''")
    once = first_wins(kept, hash16(F.col("code")), [F.col("ord")])
    code, none = F.col("code"), F.array().cast("array<string>")
    parts = C.attributes(code)
    functions = F.filter(F.coalesce("vex_functions", none), lambda f: ~F.coalesce(F.startswith(f, F.lit("@")), F.lit(False)))
    review = F.coalesce("needs_review", F.lit(False))
    return once.select(
        derived_id(F.col("id"), code).alias("id"), "code", F.coalesce("youtube_url", "source", F.lit("")).alias("source_file"), F.lit(0).alias("source_line"), hash16(code).alias("hash"), F.lit("complete").alias("stage"),
        F.coalesce("vex_context", F.lit("SOP")).alias("context"), F.coalesce("ocr_confidence", F.lit(0.8)).alias("context_confidence"),
        parts["read"].alias("attributes_read"), parts["written"].alias("attributes_written"), F.regexp_extract_all(code, F.lit(r"ch[fivs]\(|chramp\("), F.lit(0)).alias("channels"),
        functions.alias("functions"), C.size_complexity(code, F.size(functions)).alias("complexity"), F.coalesce("category", "topic", F.lit("")).alias("topic"),
        F.coalesce("topic", F.lit("")).alias("prompt"), F.coalesce("related_concepts", none).alias("alternative_prompts"), F.coalesce("explanation", F.lit("")).alias("explanation"),
        F.when(F.col("difficulty") == "beginner", 1).when(F.col("difficulty") == "advanced", 5).otherwise(3).alias("difficulty"),
        review.alias("flagged_for_review"), F.when(review, "auto-imported").otherwise("").alias("review_reason"),
    )


def tag(chunks: DataFrame, code: Column, official: Column) -> DataFrame:
    """Content type, difficulty, contexts and version by rules, where these are empty or still the default; and the decisions.

    Columns in and out: content, title, content_type, difficulty, vex_context, houdini_version_min, houdini_version_notes; out also decisions.
    """
    none, no_list = F.lit(""), F.array().cast("array<string>")
    ct, df, ver = (F.coalesce(c, none) for c in ("content_type", "difficulty", "houdini_version_min"))
    ctx = F.coalesce("vex_context", no_list)
    content, title = F.coalesce("content", none), F.coalesce("title", none)
    text = F.concat(content, F.lit(" "), title)
    chunks = chunks.withColumns({"__typed": C.typed_text(content, title), "__leveled": C.leveled_text(code, text)})
    new_ct = C.content_type(content, title, code != "", official, F.col("__typed"))
    new_df = C.difficulty(code, text, F.col("__leveled"))
    new_ctx = C.contexts(code)
    new_ver, notes = C.version(code)
    fresh = chunks.withColumns({"__ct": new_ct, "__df": new_df, "__ctx": new_ctx, "__ver": new_ver, "__notes": notes})
    set_ct = ct.isin("", "concept") & (F.col("__ct") != ct)
    set_df = df.isin("", "beginner") & (F.col("__df") != df)
    set_ctx = ((F.size(ctx) == 0) | (ctx == F.array(F.lit("sop")))) & F.col("__ctx").isNotNull() & (F.coalesce(F.col("__ctx"), no_list) != ctx)
    set_ver = (ver == "") & (F.col("__ver") != "")
    named = lambda c: F.when(c == "", "empty").otherwise(c)
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    decisions = F.array_compact(F.array(
        F.when(set_ct, F.concat(F.lit("content_type: "), named(ct), F.lit(" -> "), F.col("__ct"))),
        F.when(set_df, F.concat(F.lit("difficulty: "), named(df), F.lit(" -> "), F.col("__df"))),
        F.when(set_ctx, F.concat(F.lit("vex_context: "), listed(ctx), F.lit(" -> "), listed(F.col("__ctx")))),
        F.when(set_ver, F.concat(F.lit("houdini_version_min: "), F.col("__ver"))),
    ))
    return fresh.withColumns({
        "decisions": decisions,
        "content_type": F.when(set_ct, F.col("__ct")).otherwise(ct), "difficulty": F.when(set_df, F.col("__df")).otherwise(df), "vex_context": F.when(set_ctx, F.col("__ctx")).otherwise(ctx),
        "houdini_version_min": F.when(set_ver, F.col("__ver")).otherwise(ver), "houdini_version_notes": F.when(set_ver, F.col("__notes")).otherwise(F.coalesce("houdini_version_notes", none)),
    }).drop("__ct", "__df", "__ctx", "__ver", "__notes", "__typed", "__leveled")


def extract(chunks: DataFrame, code: Column | None = None, blocks: Column | None = None) -> DataFrame:
    """Calls joined to functions_referenced, and warnings that are not yet among validation_warnings.

    blocks: an array of codes, each judged by itself, so that lines are counted from each block's start and balances do not make up for each other; code:
    one more, judged after them. Null and empty codes say nothing.
    """
    none = F.array().cast("array<string>")
    each = F.filter(F.coalesce(blocks, none) if blocks is not None else none, lambda b: F.coalesce(b, F.lit("")) != "")
    calls, warned = F.flatten(F.transform(each, C.calls)), F.flatten(F.transform(each, C.warnings))
    if code is not None:
        said = F.coalesce(code, F.lit("")) != ""
        calls = F.concat(calls, F.when(said, C.calls(code)).otherwise(none))
        warned = F.concat(warned, F.when(said, C.warnings(code)).otherwise(none))
    return chunks.withColumns({"functions_referenced": F.array_sort(F.array_union(F.coalesce("functions_referenced", none), calls)), "validation_warnings": C.add_absent(F.col("validation_warnings"), warned)})


def real_bugs(bugs: Column, code: Column) -> Column:
    """Bugs (type, description) without those about point clouds, where the code opens none."""
    from ..functions.rules import contains_any

    kind, said = lambda b: F.lower(F.coalesce(b["type"], F.lit(""))), lambda b: F.lower(F.coalesce(b["description"], F.lit("")))
    about = lambda b: contains_any(kind(b), ["pcopen", "pcclose", "resource_leak"]) | contains_any(said(b), ["pcopen", "pcclose"])
    return F.when(contains_any(code, P.POINT_CLOUD_CALLS), bugs).otherwise(F.filter(bugs, lambda b: ~about(b)))


def repair(chunks: DataFrame, code: Column) -> DataFrame:
    """The repair pass over columns llm_topic, llm_bugs, llm_code_quality, content, and where they are there llm_secondary_topics, llm_complexity, llm_bottlenecks.

    False bugs out, topics normalised, an unsupported point-cloud topic classified anew, empty content filled from the code;
    a chunk with a topic and code that was never asked for bugs or complexity gets none of them, and unknown as their verdict.
    """
    from ..functions.rules import contains_any

    bugs = real_bugs(F.col("llm_bugs"), code)
    fewer = F.size("llm_bugs") > F.size(bugs)
    topic = C.normal_topic(F.coalesce("llm_topic", F.lit("")))
    topic = F.when((topic == "point_cloud_ops") & ~contains_any(code, P.POINT_CLOUD_TOPIC), F.coalesce(F.nullif(C.topic(code), F.lit("")), topic)).otherwise(topic)
    empty = F.coalesce(strip(F.col("content")), F.lit("")) == ""
    partly = (topic != "") & (F.coalesce(code, F.lit("")) != "")
    kinds = dict(chunks.dtypes)
    more = {}
    if "llm_secondary_topics" in kinds:
        more["llm_secondary_topics"] = F.filter(F.transform("llm_secondary_topics", C.normal_topic), lambda t: t != "")
    if "llm_complexity" in kinds:
        unasked = partly & F.col("llm_complexity").isNull()
        more["llm_complexity"] = F.when(unasked, "unknown").otherwise(F.col("llm_complexity"))
        if "llm_bottlenecks" in kinds:
            more["llm_bottlenecks"] = F.when(unasked, F.array().cast(kinds["llm_bottlenecks"])).otherwise(F.col("llm_bottlenecks"))
    none = partly & F.col("llm_bugs").isNull()
    return chunks.withColumns(more | {
        "llm_code_quality": F.when(none, "unknown").when(fewer & (F.size(bugs) == 0), "clean").when(fewer, F.coalesce("llm_code_quality", F.lit("minor_issues"))).otherwise(F.col("llm_code_quality")),
        "llm_bugs": F.when(none, F.array().cast(kinds["llm_bugs"])).otherwise(bugs), "llm_topic": topic, "content": F.when(empty, F.substring(code, 1, 200)).otherwise(F.col("content")),
    })
