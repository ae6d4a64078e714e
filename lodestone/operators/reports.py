"""Reports and summaries as frames, and the writers that put them, and corpora, into files.

Large results are written by Spark as tables or JSON lines; a document of the driver's own (an envelope, a manifest, a
report) holds only what was aggregated, and rows that are its content go beside it as JSON lines.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stats
from .export import chats, read_json, training_pairs, write_json_atomically, write_samples, write_sorted_json


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def counted(df: DataFrame, column: str) -> dict[str, int]:
    """Value -> rows, in the order of the values; a missing value is unknown."""
    return {r.value: r.n for r in stats.counts(df, column).orderBy("value").collect()}


# ---- summaries


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """One row over merged chunks (content, code_blocks, functions_referenced): total, with code, code blocks, distinct functions, average length rounded down."""
    none = F.array().cast("array<string>")
    codes = F.transform("code_blocks", lambda b: F.coalesce(b["code"], F.lit("")))
    length = F.coalesce(F.length("content"), F.lit(0)) + F.coalesce(F.aggregate(codes, F.lit(0), lambda a, c: a + F.length(c)), F.lit(0))
    n = F.coalesce(F.greatest(F.size("code_blocks"), F.lit(0)), F.lit(0))
    one = chunks.agg(F.count("*").alias("total_chunks"), F.count_if(n > 0).alias("with_code"), F.coalesce(F.sum(n), F.lit(0)).alias("total_code_blocks"), F.floor(F.coalesce(F.sum(length), F.lit(0)) / F.greatest(F.count("*"), F.lit(1))).alias("avg_chunk_length"))
    names = chunks.select(F.explode(F.coalesce("functions_referenced", none)).alias("f")).agg(F.countDistinct("f").alias("unique_functions"))
    return one.crossJoin(names)


def cleaned_stats(chunks: DataFrame, code: Column) -> DataFrame:
    """One row after repair: total, with code of 10 characters or more, and how many have each overlay field (bugs by presence, the others if not empty)."""
    some = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "").alias(c)
    return chunks.agg(F.count("*").alias("total_chunks"), F.count_if(F.length(code) >= 10).alias("with_code"), some("llm_topic"), F.count("llm_bugs").alias("llm_bugs"), some("llm_complexity"), some("prompt"), some("explanation"))


def topic_distribution(chunks: DataFrame) -> DataFrame:
    """topic, n of chunks with a topic, the largest first."""
    return chunks.where(F.coalesce("llm_topic", F.lit("")) != "").groupBy(F.col("llm_topic").alias("topic")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic")


def stage_report(samples: DataFrame) -> DataFrame:
    """measure, value, n: samples by stage (all stages, also empty ones), by context, by topic, flagged, with prompts, in all."""
    parts = [stats.zero_filled(samples, "stage", stats.STAGES).select(F.lit("stage").alias("measure"), "value", "n")]
    parts += [stats.counts(samples.withColumn("v", F.nullif(F.col(c), F.lit(""))), "v").select(F.lit(c).alias("measure"), "value", "n") for c in ("context", "topic")]
    flags = samples.agg(F.count("*").alias("total"), F.count_if(F.coalesce("flagged_for_review", F.lit(False))).alias("flagged_for_review"), F.count_if(F.coalesce("prompt", F.lit("")) != "").alias("with_prompts"))
    parts.append(flags.select(F.inline(F.array(*[F.struct(F.lit("all").alias("measure"), F.lit(c).alias("value"), F.col(c).alias("n")) for c in ("total", "flagged_for_review", "with_prompts")]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tagging_summary(tagged: DataFrame) -> DataFrame:
    """measure, value, n of tagged chunks: decisions by field, chunks by type, difficulty and context (none: sop), and with a version (n may be 0).

    One pass: each chunk gives a list of measures and values, and one aggregation counts them.
    """
    one = lambda m, v: F.struct(F.lit(m).alias("measure"), v.alias("value"))
    all_ = lambda m, vs, value=lambda v: v: F.transform(vs, lambda v: one(m, value(v)))
    known = lambda c: F.coalesce(c, F.lit("unknown"))
    says = F.concat(
        all_("changed", "decisions", lambda d: F.substring_index(d, ":", 1)), F.array(one("content_type", known("content_type")), one("difficulty", known("difficulty"))),
        all_("vex_context", F.coalesce("vex_context", F.array(F.lit("sop")))), F.when(F.coalesce("houdini_version_min", F.lit("")) != "", F.array(one("all", F.lit("with_version")))).otherwise(F.array().cast("array<struct<measure:string,value:string>>")),
    )
    counts = _items(tagged, says).select("x.measure", "x.value").groupBy("measure", "value").agg(F.count("*").alias("n"))
    zero = counts.sparkSession.createDataFrame([("all", "with_version", 0)], "measure string, value string, n long")
    return counts.unionByName(zero).groupBy("measure", "value").agg(F.sum("n").alias("n"))


def _items(df: DataFrame, array: Column) -> DataFrame:
    """x: the items of an array. By the outer form, as the other lets the optimizer write the array's expression out anew in a filter below; items are never null."""
    return df.select(F.explode_outer(array).alias("x")).where("x is not null")


def extraction_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: functions added, chunks with functions, distinct functions, warnings added. Both frames have functions_referenced and validation_warnings."""
    size = lambda c: F.sum(F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)))
    old = before.agg(size("functions_referenced").alias("f0"), size("validation_warnings").alias("w0"))
    new = after.agg(size("functions_referenced").alias("f1"), size("validation_warnings").alias("w1"), F.count_if(F.size("functions_referenced") > 0).alias("chunks_with_functions"), F.count("*").alias("chunks"))
    names = after.select(F.explode("functions_referenced").alias("f")).agg(F.countDistinct("f").alias("unique_functions"))
    return old.crossJoin(new).crossJoin(names).select((F.col("f1") - F.col("f0")).alias("functions_added"), "chunks_with_functions", "chunks", "unique_functions", (F.col("w1") - F.col("w0")).alias("warnings_added"))


def import_summary(samples: DataFrame) -> DataFrame:
    """measure, value, n of imported samples: by difficulty, and those for review."""
    by = samples.groupBy(F.col("difficulty").cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit("difficulty").alias("measure"), "value", "n")
    flagged = samples.agg(F.count_if(F.coalesce("flagged_for_review", F.lit(False))).alias("n")).select(F.lit("all").alias("measure"), F.lit("flagged_for_review").alias("value"), "n")
    return by.unionByName(flagged)


def model_summary(runs: DataFrame) -> DataFrame:
    """model, avg_seconds, avg_rate, success_rate of benchmark runs (model, seconds, tokens_per_sec, success)."""
    return runs.groupBy("model").agg(F.round(F.avg("seconds"), 3).alias("avg_seconds"), F.round(F.avg("tokens_per_sec"), 3).alias("avg_rate"), F.round(F.avg(F.col("success").cast("double")), 4).alias("success_rate"))


def worker_summary(work: DataFrame) -> DataFrame:
    """worker, processed, failed, avg_ms of the processed (0: none), success_rate (1: nothing done), of rows (worker, ok, ms)."""
    done, failed = F.count_if("ok"), F.count_if(~F.col("ok"))
    return work.groupBy("worker").agg(
        done.alias("processed"), failed.alias("failed"), F.coalesce(F.round(F.avg(F.when(F.col("ok"), F.col("ms"))), 3), F.lit(0.0)).alias("avg_ms"), F.round(F.when(F.count("ok") == 0, 1.0).otherwise(done / F.count("ok")), 4).alias("success_rate")
    )


def hourly_rate(processed: Column, seconds: Column) -> Column:
    """Items an hour; 0 before 3.6 seconds have gone by."""
    hours = seconds / 3600
    return F.when(hours < 0.001, 0.0).otherwise(processed / hours)


def recent(rows: DataFrame, order: str, most: int = 50, group: str | None = None) -> DataFrame:
    """The latest rows (by a column), in all or of each group."""
    if group is None:
        return rows.orderBy(F.desc(order)).limit(most)
    window = Window.partitionBy(group).orderBy(F.desc(order))
    return rows.withColumn("__r", F.row_number().over(window)).where(F.col("__r") <= most).drop("__r")


def browse(samples: DataFrame) -> DataFrame:
    """What a table of samples shows: the id's first 16 characters, and six more columns."""
    return samples.select(F.substring("id", 1, 16).alias("id"), "stage", "context", "topic", "difficulty", "confidence", "flagged_for_review")


def first_rows(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """A preview: the first rows in a stated order."""
    return df.orderBy(*order).limit(n)


# ---- writers


def write_corpus(samples: DataFrame, folder: str) -> dict:
    """Complete samples as JSON lines in folder/samples, and folder/metadata.json: when, how many, how many flagged."""
    done = samples.where("stage = 'complete'")
    write_samples(done, f"{folder}/samples", "json")
    n = done.agg(F.count("*").alias("n"), F.count_if(F.coalesce("flagged_for_review", F.lit(False))).alias("f")).first()
    envelope = {"generated_at": _now(), "total_samples": n.n, "flagged_for_review": n.f}
    write_json_atomically(f"{folder}/metadata.json", envelope)
    return envelope


def export_all(samples: DataFrame, folder: str) -> None:
    """Everything anew: corpus, training pairs, chats and a metadata table of complete samples."""
    write_corpus(samples, f"{folder}/corpus")
    done = samples.where("stage = 'complete'")
    pairs = training_pairs(done)
    write_samples(pairs, f"{folder}/training", "json")
    write_samples(chats(pairs), f"{folder}/chat", "json")
    write_samples(done.select("id", "context", "topic", "difficulty", "confidence", "flagged_for_review"), f"{folder}/metadata", "csv")
    write_samples(done, f"{folder}/parquet", "parquet")


def write_merged(chunks: DataFrame, pairs: DataFrame, folder: str, threshold: float, version: str = "") -> dict:
    """Merged chunks with sorted keys in folder/merged, their directory (five fields) in folder/directory, statistics, manifest, and the pairs found, if there are any."""
    write_sorted_json(chunks, f"{folder}/merged")
    write_samples(chunks.select("id", "source_id", "content_type", "difficulty", "title"), f"{folder}/directory", "json")
    figures = corpus_stats(chunks).first().asDict() | {f"by_{k}": counted(chunks, c) for k, c in (("source", "source_id"), ("content_type", "content_type"), ("difficulty", "difficulty"))}
    n = pairs.count()
    write_json_atomically(f"{folder}/stats.json", figures)
    write_json_atomically(f"{folder}/manifest.json", {"generated_at": _now(), "pipeline_version": version, "statistics": figures, "dedup_pairs": n, "chunks": "directory"})
    if n:
        write_samples(pairs, f"{folder}/dedup_pairs", "json")
        write_json_atomically(f"{folder}/dedup_report.json", {"threshold": threshold, "pairs_found": n, "pairs": "dedup_pairs"})
    return figures


def write_cleaned_stats(chunks: DataFrame, code: Column, path: str) -> dict:
    """The statistics document after repair."""
    one = cleaned_stats(chunks, code).first().asDict()
    out = {"total_chunks": one.pop("total_chunks"), "with_code": one.pop("with_code"), "llm_coverage": one}
    out |= {f"by_{k}": counted(chunks, c) for k, c in (("source", "source_id"), ("content_type", "content_type"), ("difficulty", "difficulty"))}
    out["by_llm_topic"] = {r.topic: r.n for r in topic_distribution(chunks).collect()}
    write_json_atomically(path, out)
    return out


def write_dedup_report(acted: DataFrame, report: DataFrame, folder: str) -> dict:
    """Statistics in folder/dedup_report.json, all pairs in folder/pairs, those to drop or merge in folder/actions."""
    from .dedup import actionable

    write_samples(acted.orderBy(F.desc("similarity"), "a", "b"), f"{folder}/pairs", "json")
    todo = actionable(acted)
    if todo.limit(1).count():
        write_samples(todo, f"{folder}/actions", "json")
    out = report.first().asDict() | {"pairs_in": "pairs"}
    write_json_atomically(f"{folder}/dedup_report.json", out)
    return out


def decision_log(tagged: DataFrame) -> DataFrame:
    """decision: one row for each decision of tagging."""
    return _items(tagged, F.col("decisions")).select(F.col("x").alias("decision"))


def write_decision_log(tagged: DataFrame, path: str) -> None:
    write_samples(decision_log(tagged), path, "json")


def write_graph(edges: DataFrame, intros: DataFrame, episodes: DataFrame, folder: str) -> dict:
    """Edges as a table, prerequisites of each chunk and the best introductions as JSON lines, and the graph's figures."""
    from .graph import graph_stats

    write_samples(edges, f"{folder}/edges", "parquet")
    write_samples(edges.groupBy(F.col("src").alias("id")).agg(F.array_sort(F.collect_set("dst")).alias("prerequisites")), f"{folder}/prerequisites", "json")
    write_samples(intros.where("place <= 5").groupBy("concept").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"]).alias("introductions")), f"{folder}/introductions", "json")
    out = graph_stats(edges, intros, episodes).first().asDict()
    write_json_atomically(f"{folder}/graph.json", out)
    return out


def evaluation_report(per_query: DataFrame, required: DataFrame, config: dict) -> dict:
    """The evaluation's configuration, its means, and one entry a query, rounded to 4 places. required: query_id, has_required."""
    from .evaluate import summary

    rows = per_query.join(required, "query_id", "left").withColumn("has_required", F.coalesce("has_required", F.lit(True)))
    one = summary(rows).first().asDict()
    one["function_match_rate"] = rows.agg(F.round(F.avg(F.col("has_required").cast("double")), 4)).first()[0]
    return {"config": config | {"n_queries": one["queries"]}, "aggregate": one, "per_query": [r.asDict() for r in rows.orderBy("query_id").collect()]}


def write_evaluation(per_query: DataFrame, required: DataFrame, config: dict, path: str) -> dict:
    out = evaluation_report(per_query, required, config)
    write_json_atomically(path, out)
    return out


def write_job_results(jobs: DataFrame, path: str) -> None:
    """Completed jobs as JSON lines: job_id, task_type, input, result, confidence, status, processing_time."""
    done = jobs.where("result is not null")
    write_samples(done.select("job_id", "task_type", "input", "result", "confidence", "status", (F.coalesce("completed_at", F.lit(0.0)) - F.coalesce("started_at", F.lit(0.0))).alias("processing_time")), path, "json")


def write_by_page(chunks: DataFrame, page: str, folder: str) -> None:
    """A folder of JSON lines for each page, and one of all."""
    chunks.repartition(page).write.partitionBy(page).json(f"{folder}/pages")
    write_samples(chunks, f"{folder}/all", "json")


def write_index_metadata(chunks: DataFrame, path: str) -> None:
    """What a search shows of each chunk: id, title, source, type, difficulty and the content's beginning."""
    from ..functions.text import preview

    write_samples(chunks.select("id", "title", F.col("source_id").alias("source"), "content_type", "difficulty", preview(F.col("content")).alias("content")), path, "parquet")


def rewrite(spark, folder: str, name: str, df: DataFrame) -> str:
    """A corpus in place: the new version is written beside the old one, then folder/<name>.json names it; the old one stays readable until then."""
    number = read_json(f"{folder}/{name}.json", {"version": 0})["version"] + 1
    target = f"{folder}/{name}-v{number:06d}"
    df.write.parquet(target)
    write_json_atomically(f"{folder}/{name}.json", {"version": number, "path": target})
    return target


def current(spark, folder: str, name: str) -> DataFrame:
    """The version of a corpus that rewrite() named last."""
    return spark.read.parquet(read_json(f"{folder}/{name}.json")["path"])
