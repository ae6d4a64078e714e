"""Exports: training pairs, chats, metadata tables, topic pages, keyed indexes, manifests."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import packs as P
from ..functions import text as T
from ..sources import hadoop
from .stats import keywords

MIN_TOPIC = 10
AGENT = "sop_agent"  # whom all topics are relevant to
#: Columns whose words are a topic's keywords.
KEYWORD_LISTS = ("functions_referenced", "attributes_read", "attributes_written", "alternative_prompts", "vex_context")


def training_pairs(samples: DataFrame) -> DataFrame:
    """prompt, completion, metadata of samples with a prompt that are not flagged."""
    kept = samples.where((F.coalesce("prompt", F.lit("")) != "") & ~F.coalesce("flagged_for_review", F.lit(False)))
    return kept.select("prompt", F.col("code").alias("completion"), F.struct("context", "difficulty", "topic").alias("metadata"))


def chats(pairs: DataFrame) -> DataFrame:
    """messages: the prompt as user, the completion as assistant."""
    return pairs.select(F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content"))).alias("messages"))


def write_samples(df: DataFrame, path: str, kind: str) -> None:
    """One of json, csv (with header), parquet."""
    {"json": df.write.json, "csv": lambda p: df.write.option("header", True).csv(p), "parquet": df.write.parquet}[kind](path)


def write_sorted_json(df: DataFrame, path: str) -> None:
    """JSON lines with keys in alphabetical order."""
    df.select(*sorted(df.columns)).write.json(path)


def sparse(df: DataFrame, columns: list[str]) -> Column:
    """JSON of the columns that are neither null, empty nor false."""
    kinds = dict(df.dtypes)

    def kept(c: str) -> Column:
        col = F.col(c)
        if kinds[c] == "string":
            return F.nullif(col, F.lit(""))
        if kinds[c].startswith("array"):
            return F.when(F.size(col) > 0, col)
        return F.when(col, col) if kinds[c] == "boolean" else F.when(col != 0, col)

    return F.to_json(F.struct(*[kept(c).alias(c) for c in columns]))


def difficulty_rank(difficulty: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, P.DIFFICULTIES)), difficulty), F.lit(0)).cast("int") - 1, F.lit(len(P.DIFFICULTIES)))


def _entry(title: Column, code: Column, text: Column) -> Column:
    """A page's entry: heading, first code block, first sentence."""
    block = F.when(T.strip(F.coalesce(code, F.lit(""))) != "", F.concat(F.lit("```vex\n"), T.truncate_lines(code), F.lit("\n```\n\n")))
    said = F.when(F.coalesce(text, F.lit("")) != "", F.concat(T.first_sentence(text), F.lit("\n\n")))
    return F.concat(F.lit("### "), title, F.lit("\n\n"), F.coalesce(block, F.lit("")), F.coalesce(said, F.lit("")))


def topic_entries(chunks: DataFrame) -> DataFrame:
    """topic, level, rank, source_id, id, entry: one row for each entry of a page, in any number; pages of large topics are written from these, sorted by rank, source_id and id."""
    level = F.coalesce("difficulty", F.lit("unknown"))
    shown = chunks.where(level.isin(*P.DIFFICULTIES, "unknown"))
    entry = _entry(F.coalesce("title", "id"), F.col("code"), F.col("content"))
    return shown.select("topic", level.alias("level"), difficulty_rank(level).alias("rank"), F.coalesce("source_id", F.lit("")).alias("source_id"), F.coalesce("id", F.lit("")).alias("id"), entry.alias("entry"))


def write_entries(chunks: DataFrame, folder: str) -> None:
    """A folder of text for each topic, its entries in order; a topic is split over files by ranges, so it may be of any size."""
    rows = topic_entries(chunks).repartitionByRange("topic", "rank", "source_id", "id").sortWithinPartitions("topic", "rank", "source_id", "id")
    rows.select("topic", "entry").write.partitionBy("topic").text(folder)


def topic_pages(chunks: DataFrame, labels: dict[str, str] | None = None, title: str = "Corpus", origin: str = "corpus") -> DataFrame:
    """topic, page. chunks: topic, id, title, difficulty, source_id, code, content. Sections by difficulty, entries by source and id.

    A page is one row, so its size is that of a topic; topics of any size belong in a table instead.
    """
    known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]) if labels else None
    source = F.coalesce(F.element_at(known, F.col("source_id")), F.col("source_id")) if known is not None else F.col("source_id")
    level = F.coalesce("difficulty", F.lit("unknown"))
    rows = chunks.select("topic", level.alias("level"), source.alias("source"), F.struct(F.coalesce("source_id", F.lit("")), F.coalesce("id", F.lit("")), _entry(F.coalesce("title", "id"), F.col("code"), F.col("content")).alias("e")).alias("s"))
    heading = F.when(F.col("level") == "unknown", "Uncategorized").otherwise(F.initcap("level"))
    sections = rows.where(F.col("level").isin(*P.DIFFICULTIES, "unknown")).groupBy("topic", "level").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["e"]), "").alias("body"))
    shown = sections.select("topic", F.struct(difficulty_rank(F.col("level")).alias("r"), F.concat(F.lit("## "), heading, F.lit(" ("), F.col("n").cast("string"), F.lit(" examples)\n\n"), F.col("body")).alias("t")).alias("x"))
    bodies = shown.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("body"))
    heads = rows.groupBy("topic").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"))
    head = F.concat(F.lit(f"# {title}: "), T.pretty_label(F.col("topic")), F.lit("\n\n> "), F.col("n").cast("string"), F.lit(f" examples from {origin}. Sources: "), F.col("sources"), F.lit("\n\n"))
    return heads.join(bodies, "topic", "left").select("topic", F.concat(head, F.coalesce("body", F.lit(""))).alias("page"))


def grouped_topics(chunks: DataFrame, least: int = MIN_TOPIC) -> DataFrame:
    """Chunks (column topic) with small topics pooled as misc; own_topic keeps the name."""
    from .stats import pooled_groups

    kept = chunks.withColumn("own_topic", F.col("topic"))
    return pooled_groups(kept, "topic", least).withColumn("topic", F.col("grp")).drop("grp")


def misc_page(chunks: DataFrame, labels: dict[str, str] | None = None, title: str = "Corpus", origin: str = "corpus") -> DataFrame:
    """page: one page of small topics, sections by topic, entries by difficulty, source and id. chunks: as for topic_pages()."""
    label = T.label_of(F.col("source_id"), labels) if labels else F.col("source_id")
    order = F.struct(difficulty_rank(F.coalesce("difficulty", F.lit("unknown"))), F.coalesce("source_id", F.lit("")), F.coalesce("id", F.lit("")), _entry(F.coalesce("title", "id"), F.col("code"), F.col("content")).alias("e"))
    rows = chunks.select(F.coalesce("topic", F.lit("misc")).alias("topic"), F.coalesce(label, F.lit("unknown")).alias("source"), order.alias("s"))
    sections = rows.groupBy("topic").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["e"]), "").alias("body"))
    parts = sections.select(F.struct("topic", F.concat(F.lit("## "), T.pretty_label(F.col("topic")), F.lit(" ("), F.col("n").cast("string"), F.lit(" examples)\n\n"), "body").alias("t")).alias("x"))
    body = parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("body"))
    head = rows.agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"))
    start = F.concat(F.lit(f"# {title}: Miscellaneous Topics\n\n> "), F.col("n").cast("string"), F.lit(f" examples from {origin} (small topics). Sources: "), "sources", F.lit("\n\n"))
    return head.crossJoin(body).select(F.concat(start, "body").alias("page"))


def semantic_entries(chunks: DataFrame, keywords: DataFrame, namespace: str = "corpus_", title: str = "Corpus") -> DataFrame:
    """file_key, summary, description, keywords for each topic."""
    sources = F.array_sort(F.collect_set(F.nullif("source_id", F.lit(""))))
    heads = chunks.groupBy("topic").agg(F.count("*").cast("string").alias("n"), F.array_join(sources, ", ").alias("sources")).withColumn("label", F.when(F.col("topic") == "misc", "Miscellaneous Topics").otherwise(T.pretty_label(F.col("topic"))))
    summary = F.concat(F.lit(f"{title}: "), "label", F.lit(" ("), "n", F.lit(" examples)"))
    description = F.concat(F.lit("Labeled examples for "), F.lower("label"), F.lit(". Sources: "), "sources", F.lit(". Covers "), "n", F.lit(" code snippets with difficulty ratings and metadata."))
    return heads.join(keywords, "topic", "left").select(F.concat(F.lit(namespace), "topic").alias("file_key"), summary.alias("summary"), description.alias("description"), "keywords")


def merge_namespace(existing: DataFrame, new: DataFrame, key: str, prefix: str) -> DataFrame:
    """Existing rows outside a namespace, and the new rows in it."""
    return existing.where(~F.col(key).startswith(prefix)).unionByName(new, allowMissingColumns=True)


def stale(existing: DataFrame, planned: DataFrame, key: str) -> DataFrame:
    return existing.join(planned.select(key), key, "left_anti")


def write_json_atomically(path: str, value: object) -> None:
    """A small document where Spark's data lies, whatever the scheme: written beside the target, then renamed over it."""
    hadoop.write_text(SparkSession.active(), path, json.dumps(value, indent=2, ensure_ascii=False, sort_keys=True))


def read_json(path: str, none: object = None) -> object:
    """A small document, or what stands for none."""
    text = hadoop.read_text(SparkSession.active(), path)
    return none if text is None else json.loads(text)


def write_named(files: DataFrame, folder: str) -> list[str]:
    """Writes files (name, text) into a folder from the executors, each as a whole; the names. Texts never pass the driver."""
    from pyarrow import fs

    SparkSession.active()
    place = folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder)
    store, root = fs.FileSystem.from_uri(place)
    store.create_dir(root)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(place)
        for part in parts:
            for name, text in part[["name", "text"]].itertuples(index=False):
                beside = f"{root}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    out.write(text.encode())
                store.move(beside, f"{root}/{name}")  # a task that runs twice writes the same
            yield part[["name"]]

    return sorted(r.name for r in files.select("name", "text").mapInPandas(run, "name string").collect())


def corpus_hash(df: DataFrame) -> str:
    """A hash of all rows that does not depend on their order."""
    row = df.select(F.xxhash64(*df.columns).alias("h")).agg(F.count("*"), F.expr("bit_xor(h)"), F.sum(F.col("h").cast("decimal(20,0)"))).first()
    return "-".join(str(x or 0) for x in row)


def sync(df: DataFrame, folder: str, namespace: str = "corpus_", dry_run: bool = False, force: bool = False, agent: str = AGENT) -> dict:
    """Writes topic pages, semantic index, relevance map and manifest unless the corpus is unchanged; foreign files and keys stay, stale pages and keys of the namespace go.

    df: grouped_topics() or chunks of a topic each; what it has of KEYWORD_LISTS gives the keywords of the index. Pages are written by the executors.
    """
    spark = df.sparkSession
    manifest = f"{folder}/manifest.json"
    mark = corpus_hash(df)
    if read_json(manifest, {}).get("corpus") == mark and not force:
        return {"skipped": True, "written": [], "deleted": []}
    grouped = "own_topic" in df.columns
    pages = topic_pages(df.where("topic <> 'misc'") if grouped else df)
    names = [r.topic for r in df.select("topic").distinct().where("topic is not null").collect()]
    if grouped and "misc" in names:
        pages = pages.unionByName(misc_page(df.where("topic = 'misc'").withColumn("topic", F.col("own_topic"))).select(F.lit("misc").alias("topic"), "page"))
    planned = {f"{namespace}{t}.md" for t in names}
    gone = [n for n in hadoop.names(spark, folder) if n.startswith(namespace) and n.endswith(".md") and n not in planned]
    plan = {"skipped": False, "written": sorted(planned), "deleted": gone}
    if dry_run:
        return plan
    write_named(pages.select(F.concat(F.lit(namespace), "topic", F.lit(".md")).alias("name"), F.col("page").alias("text")), folder)
    for name in gone:
        hadoop.remove(spark, f"{folder}/{name}")
    lists = [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in KEYWORD_LISTS if c in df.columns]
    keys = keywords(df, "topic", lists or [F.array().cast("array<string>")])
    entries = {r.file_key: {"summary": r.summary, "description": r.description, "keywords": r.keywords or [], "reference_file": r.file_key} for r in semantic_entries(df, keys, namespace).collect()}
    for name, new in (("semantic_index", entries), ("agent_relevance_map", dict.fromkeys(entries, agent))):
        old = read_json(f"{folder}/{name}.json", {})
        write_json_atomically(f"{folder}/{name}.json", {k: v for k, v in old.items() if not k.startswith(namespace)} | new)
    write_json_atomically(manifest, {"corpus": mark, "files": sorted(planned)})
    return plan
