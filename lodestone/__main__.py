"""Command lines of the steps: python -m lodestone STEP --input PATH --output PATH [--dry-run] [--limit N] [...].

Corpora are JSON lines (or parquet, by the path's suffix) in, and folders of the same kind out.
"""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import code as C
from .functions import text as T
from .operators import dedup, enrich, evaluate, export, graph, records, reports, search, vectors
from .sources import files, html


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(records.chunk_schema()).json(path)


def _codes(df: DataFrame, sep: str = " ") -> DataFrame:
    return df.withColumn("__code", C.joined_code(sep, F.transform("code_blocks", lambda b: b["code"]), F.col("code")))


def _shown(df: DataFrame, args: argparse.Namespace, *order: str) -> bool:
    if args.dry_run:
        reports.first_rows(df, list(order), args.limit or 10).show(truncate=80)
    return args.dry_run


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    found = files.ingest(spark, args.input)
    if not _shown(found, args, "path", "place"):
        found.write.json(args.output)


def markdown(spark: SparkSession, args: argparse.Namespace) -> None:
    found = files.markdown_chunks(files.directory(spark, args.input), args.source or "local-skill")
    if not _shown(found, args, "id"):
        found.write.json(args.output)


def wiki(spark: SparkSession, args: argparse.Namespace) -> None:
    found = html.wiki_chunks(html.saved_pages(spark, args.input), source_id=args.source or "wiki")
    if not _shown(found, args, "id"):
        found.write.json(args.output)


def reference(spark: SparkSession, args: argparse.Namespace) -> None:
    found = html.reference_chunks(html.saved_pages(spark, args.input), args.source or "reference")
    if not _shown(found, args, "id"):
        found.write.json(args.output)


def migrate(spark: SparkSession, args: argparse.Namespace) -> None:
    found = records.migrate(spark.read.text(args.input))
    if not _shown(found, args, "id"):
        export.write_sorted_json(found, args.output)


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    sources = [_read(spark, p).withColumn("row_ord", F.monotonically_increasing_id()) for p in args.input.split(",")]
    rows = files.union_in_order(*sources)
    once = dedup.first_wins(rows, F.col("checksum"), [F.col("src_ord"), F.col("row_ord")]).drop("src_ord", "row_ord")
    if _shown(once, args, "id"):
        return
    text = T.comparable(F.col("content"), F.transform("code_blocks", lambda b: b["code"]))
    pairs = dedup.jaccard_pairs(dedup.hashed_sets(once.where("id <> ''").withColumn("__t", text), "id", F.col("__t")), args.threshold)
    reports.write_merged(once, pairs, args.output, args.threshold, records.PIPELINE_VERSION)


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    before = _read(spark, args.input)
    after = records.extract(before, F.col("code") if "code" in before.columns else None, F.transform("code_blocks", lambda b: b["code"]) if "code_blocks" in before.columns else None)
    print(json.dumps(reports.extraction_summary(before, after).first().asDict()))
    if not args.dry_run:
        export.write_sorted_json(after, args.output)


def tag(spark: SparkSession, args: argparse.Namespace) -> None:
    tagged = records.tag(_codes(_read(spark, args.input)), F.col("__code"), F.coalesce(F.col("source_id"), F.lit("")) == (args.source or ""))
    if not _shown(tagged.select("id", "decisions"), args, "id"):
        export.write_sorted_json(tagged.drop("__code", "decisions"), f"{args.output}/corpus")
        reports.write_decision_log(tagged, f"{args.output}/tagging_log")
        reports.tagging_summary(tagged).show(100, truncate=False)


def link(spark: SparkSession, args: argparse.Namespace) -> None:
    chunks = _read(spark, args.input).withColumn("ord", F.monotonically_increasing_id())
    told = F.concat_ws(" ", F.coalesce("content", F.lit("")), F.coalesce("title", F.lit("")))
    intros = graph.concept_intros(chunks.select("id", F.col("source_authority").alias("authority"), "ord", told.alias("t")), F.col("t"), 5)
    episodes = graph.first_of_episodes(chunks.select("id", T.episode(F.col("id")).alias("episode"), "ord"))
    calls = chunks.select("id", F.coalesce("functions_referenced", F.array().cast("array<string>")).alias("calls"))
    edges = graph.prerequisite_edges(calls, intros, episodes, graph.mentions(chunks.select("id", told.alias("t")), F.col("t")))
    if not _shown(edges, args, "src", "dst"):
        export.write_sorted_json(graph.merge_prerequisites(chunks.drop("ord"), edges), f"{args.output}/corpus")
        reports.write_graph(edges, intros, episodes, f"{args.output}/graph")


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    docs = _read(spark, args.input).where("id <> ''").select("id", F.col("source_id").alias("source"), F.col("source_authority").alias("authority"), T.comparable(F.col("content"), F.transform("code_blocks", lambda b: b["code"]), F.col("code")).alias("t"))
    sets, members = dedup.prepared(dedup.hashed_sets(docs, "id", F.col("t"), least_words=5))
    links = dedup.with_copies(dedup.jaccard_pairs(sets, args.threshold, members), members, docs)
    acted = dedup.actions(dedup.with_sources(links, docs))
    if not _shown(acted, args, "a", "b"):
        indexed = members.count()
        found = dedup.report_stats(acted, dedup.membership(links), indexed, docs.count() - indexed, args.threshold)
        reports.write_dedup_report(acted, found, args.output)


def repair(spark: SparkSession, args: argparse.Namespace) -> None:
    mended = records.repair(_codes(_read(spark, args.input), "\n"), F.col("__code"))
    if not _shown(mended.select("id", "llm_topic", "llm_code_quality"), args, "id"):
        export.write_sorted_json(mended.drop("__code"), f"{args.output}/corpus")
        reports.write_cleaned_stats(mended, F.col("__code"), f"{args.output}/stats.json")


def _hook(name: str) -> Callable:
    """The function that module:function names: a model or an embedder, which the library has none of."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def import_samples(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = spark.read.schema(" ".join(records.UPSTREAM.split())).json(args.input).withColumn("ord", F.monotonically_increasing_id())
    samples = records.import_records(raw)
    n = raw.count()
    converted = raw.where(T.strip(F.col("code")) != "").count()
    told = {f"{r.measure}:{r.value}": r.n for r in reports.import_summary(samples).collect()}  # a few measures
    print(json.dumps({"records": n, "converted": converted, "skipped": n - converted, "samples": samples.count()} | told, sort_keys=True))
    if not args.dry_run:
        export.write_sorted_json(samples, args.output)


def enrich_chunks(spark: SparkSession, args: argparse.Namespace) -> None:
    graph.shared_folder(spark)
    chunks = _codes(_read(spark, args.input), "\n")
    lacking = lambda df, tier: enrich.requests(df, F.col("__code"), tier).count()
    told = {}
    for tier in [args.tier] if args.tier else [1, 2]:
        before = lacking(chunks, tier)
        told[f"tier{tier}"] = {"lacking": before}
        if not args.dry_run:
            chunks = enrich.enrich(chunks, F.col("__code"), _hook(args.model), f"{args.output}/answers", tier, limit=args.limit, in_flight=args.concurrency).checkpoint()
            told[f"tier{tier}"]["enriched"] = before - lacking(chunks, tier)
    print(json.dumps(told))
    if not args.dry_run:
        export.write_sorted_json(chunks.drop("__code"), f"{args.output}/corpus")


def _text() -> Column:
    codes = F.transform("code_blocks", lambda b: b["code"])
    return T.searchable(F.col("title"), F.col("content"), codes, F.col("code"), F.col("prompt"), F.col("explanation"))


def _found(spark: SparkSession, args: argparse.Namespace, folder: str, asked: DataFrame, k: int) -> DataFrame:
    """query_id, id, score, rank of questions (query_id, query) from an index, by words; with an embedder from its vectors too, both lists fused."""
    words = search.search_index(search.open_index(spark, folder), asked, "query_id", F.col("query"), 3 * k if args.embedder else k)
    if not args.embedder:
        return words
    meant = search.embed(asked, "query_id", F.col("query"), _hook(args.embedder))
    near, _ = vectors.search_vectors(vectors.open_vectors(spark, f"{folder}/vectors"), meant, "id", "vector", 3 * k)
    return search.hybrid(words, near, k)


def evaluation(spark: SparkSession, args: argparse.Namespace) -> None:
    k = args.limit or 10
    chunks = _read(spark, args.input)
    judged = spark.read.schema("id string, query string, relevant_patterns array<string>, required_functions array<string>").json(args.questions)
    asked = judged.select(F.col("id").alias("query_id"), "query")
    graph.shared_folder(spark)
    ranked = _found(spark, args, args.index, asked, k).checkpoint()
    relevant = evaluate.judged(chunks.withColumn("__t", _text()), F.col("__t"), judged.select(F.col("id").alias("query_id"), F.col("relevant_patterns").alias("patterns")))
    per = evaluate.metrics(ranked, relevant, k)
    calls = chunks.select("id", F.coalesce("functions_referenced", F.array().cast("array<string>")).alias("calls"))
    held = evaluate.has_required(ranked, calls, judged.select(F.col("id").alias("query_id"), F.coalesce("required_functions", F.array().cast("array<string>")).alias("required")))
    per = per.join(held, "query_id", "left")
    print(json.dumps(evaluate.summary(per).first().asDict()))
    if _shown(per, args, "query_id"):
        return
    per.orderBy("query_id").write.json(f"{args.output}/per_query")
    evaluate.summary(per).write.json(f"{args.output}/summary")


def index(spark: SparkSession, args: argparse.Namespace) -> None:
    chunks, text = _read(spark, args.input), _text()
    if args.dry_run:
        search.document_lengths(chunks, "id", text).agg(F.count("*").alias("chunks"), F.sum("dl").alias("tokens")).show()
        return
    search.build_index(chunks, "id", text, args.output)
    if args.embedder:
        vectors.build_vectors(search.embed(chunks, "id", text, _hook(args.embedder)), "id", "vector", f"{args.output}/vectors")
    reports.write_index_metadata(chunks, f"{args.output}/metadata")


def ask_index(spark: SparkSession, args: argparse.Namespace) -> None:
    asked = spark.createDataFrame([("q", args.query)], "query_id string, query string")
    _found(spark, args, args.input, asked, args.limit or 10).orderBy("rank").show(truncate=False)


def sync(spark: SparkSession, args: argparse.Namespace) -> None:
    chunks = _read(spark, args.input).where("llm_topic <> ''")
    pages = chunks.select(F.col("llm_topic").alias("topic"), "id", "title", "difficulty", "source_id", F.coalesce(F.get("code_blocks", F.lit(0))["code"], F.lit("")).alias("code"), F.coalesce(F.nullif("content", F.lit("")), "explanation").alias("content"), *[c for c in export.KEYWORD_LISTS if c in chunks.columns])
    grouped = export.grouped_topics(pages, args.least)
    print(json.dumps(export.sync(grouped, args.output, dry_run=args.dry_run, force=args.force)))


STEPS: dict[str, Callable[[SparkSession, argparse.Namespace], None]] = {
    "ingest": ingest, "import": import_samples, "markdown": markdown, "wiki": wiki, "reference": reference, "migrate": migrate, "merge": merge, "extract": extract, "tag": tag, "link": link, "dedup-report": report, "repair": repair, "enrich": enrich_chunks, "index": index, "search": ask_index, "evaluate": evaluation, "sync": sync,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestone", description=__doc__)
    p.add_argument("step", choices=STEPS)
    p.add_argument("--input", required=True, help="a folder or file; merge takes several, comma-separated, in their order")
    p.add_argument("--output", default="")
    p.add_argument("--threshold", type=float, default=0.85)
    p.add_argument("--limit", type=int)
    p.add_argument("--least", type=int, default=export.MIN_TOPIC, help="examples of a topic with a page of its own")
    p.add_argument("--source", help="the source's id; of tag, that of the official source")
    p.add_argument("--query", default="")
    p.add_argument("--questions", help="JSON lines of id, query, relevant_patterns, required_functions, for evaluate")
    p.add_argument("--index", help="the index that evaluate asks")
    p.add_argument("--model", help="module:function that answers (tier, code), for enrich")
    p.add_argument("--embedder", help="module:function that gives vectors of texts: index stores them, search and evaluate fuse both lists")
    p.add_argument("--tier", type=int, choices=[1, 2])
    p.add_argument("--concurrency", type=int, default=8, help="calls of enrich at once")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--force", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    STEPS[args.step](spark or SparkSession.builder.appName(f"lodestone {args.step}").getOrCreate(), args)


if __name__ == "__main__":
    main()
