"""Enrichment by models: requests for what records lack, answers taken over in any of their shapes, job lists, and question answering over a corpus."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import unfence
from ..sources import hadoop
from .models import REVIEW_CONFIDENCE, TIER_ONE, Model, call_models, needs_tier_one, needs_tier_two, route, unflagged
from .search import keyword_search

BUG = "struct<type:string,severity:string,location:string,description:string,suggestion:string>"


def _none() -> Column:
    return F.array().cast("array<string>")


def _kind(v: Column) -> Column:
    """STRING, ARRAY, OBJECT or another word; empty if there is no value."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), F.lit(""))


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def parsed_results(answers: DataFrame) -> DataFrame:
    """id, r (VARIANT), error: answers (id, answer) freed of fences; what is no JSON is an error that shows its beginning."""
    v = F.try_parse_json(unfence(F.col("answer")))
    return answers.select("id", v.alias("r"), F.when(v.isNull(), F.concat(F.lit("JSON parse: "), F.coalesce(F.substring("answer", 1, 200), F.lit("")))).alias("error"))


def apply_tier_one(chunks: DataFrame, results: DataFrame) -> DataFrame:
    """Chunks with topic, secondary topics, bugs, quality, complexity and bottlenecks from results (id, r VARIANT, error); these overwrite, and a result in error changes nothing.

    topic: a name, or an object with primary (or primary_topic) and secondary (or secondary_topics). bugs: a list, or an
    object with issues (or bugs) and quality (or overall_quality). complexity: a name, or an object with class (or
    complexity) and bottlenecks.
    """
    r = F.col("__r")
    topic, bugs, level = (_get(r, f"$.{p}", "variant") for p in ("topic", "bugs", "complexity"))
    kt, kb, kl = _kind(topic), _kind(bugs), _kind(level)
    listed = lambda *paths: F.coalesce(*[_get(r, p, "array<string>") for p in paths], _none())
    found = lambda *paths: F.coalesce(*[_get(r, p, f"array<{BUG}>") for p in paths], F.array().cast(f"array<{BUG}>"))
    issues = F.when(kb == "ARRAY", found("$.bugs")).otherwise(found("$.bugs.issues", "$.bugs.bugs"))
    new = {
        "llm_topic": F.when(kt == "STRING", _get(r, "$.topic")).otherwise(F.coalesce(_get(r, "$.topic.primary"), _get(r, "$.topic.primary_topic"), F.lit(""))),
        "llm_secondary_topics": F.when(kt == "STRING", _none()).otherwise(listed("$.topic.secondary", "$.topic.secondary_topics")),
        "llm_bugs": issues,
        "llm_code_quality": F.when(kb == "ARRAY", F.when(F.size(issues) > 0, "minor_issues").otherwise("clean")).when(kb.isin("OBJECT", ""), F.coalesce(_get(r, "$.bugs.quality"), _get(r, "$.bugs.overall_quality"), F.lit("unknown"))).otherwise("unknown"),
        "llm_complexity": F.when(kl == "STRING", _get(r, "$.complexity")).otherwise(F.coalesce(_get(r, "$.complexity.class"), _get(r, "$.complexity.complexity"), F.lit("unknown"))),
        "llm_bottlenecks": F.when(kl == "STRING", _none()).otherwise(listed("$.complexity.bottlenecks")),
    }
    kinds = {"llm_secondary_topics": "array<string>", "llm_bugs": f"array<{BUG}>", "llm_bottlenecks": "array<string>"}
    return _taken(chunks, results, new, kinds, overwrite=True)


def apply_tier_two(chunks: DataFrame, results: DataFrame) -> DataFrame:
    """Chunks with prompt, alternative prompts and explanation from results where they have none, and key concepts wherever a result has some."""
    r = F.col("__r")
    new = {"prompt": _get(r, "$.prompt"), "alternative_prompts": _get(r, "$.alternative_prompts", "array<string>"), "explanation": _get(r, "$.explanation"), "llm_key_concepts": _get(r, "$.key_concepts", "array<string>")}
    return _taken(chunks, results, new, {"alternative_prompts": "array<string>", "llm_key_concepts": "array<string>"}, overwrite=False)


def _taken(chunks: DataFrame, results: DataFrame, new: dict[str, Column], kinds: dict[str, str], overwrite: bool) -> DataFrame:
    got = results.where("error is null").select("id", F.col("r").alias("__r"))
    out = chunks.join(got, "id", "left")
    columns = {}
    for name, value in new.items():
        kind = kinds.get(name, "string")
        old = F.col(name).cast(kind) if name in chunks.columns else F.lit(None).cast(kind)
        some = (lambda c, kind=kind: F.coalesce(F.size(c) > 0, F.lit(False)) if kind.startswith("array") else F.coalesce(c, F.lit("")) != "")
        take = F.col("__r").isNotNull() if overwrite else some(value) & (F.lit(name == "llm_key_concepts") | ~some(old))
        columns[name] = F.when(take, value).otherwise(old)
    return out.withColumns(columns).drop("__r")


def requests(chunks: DataFrame, code: Column, tier: int) -> DataFrame:
    """id, code of the chunks that lack what a tier gives."""
    lacking = needs_tier_one(code, F.col("llm_topic")) if tier == 1 else needs_tier_two(code, F.col("prompt"), F.col("explanation"))
    return chunks.where(lacking).select("id", code.alias("code"))


PART_BYTES = 256 << 20  # of texts that one task is given


def enrich(chunks: DataFrame, code: Column, model: Callable[[int, str], str], folder: str, tier: int, batch: int = 50, limit: int | None = None, in_flight: int = 8) -> DataFrame:
    """Chunks enriched by one combined call each (model: tier, code -> JSON text), in batches that are kept below a folder as they end.

    A run that was broken off goes on where it was: chunks whose answer is there are not asked about again. Failed calls
    are kept as errors of that run only. limit: so many chunks that have no answer yet, by id, so that repeated runs get on. in_flight: most calls at once over the
    whole job: a batch has few partitions, and each of these calls from a few threads, partitions times threads being the bound. A batch is cut into more where its texts would give a
    task over PART_BYTES; what is asked is then dealt to files once, and each batch reads its own.
    """
    spark = chunks.sparkSession
    asked = requests(chunks, code, tier)
    threads = next(t for t in (4, 3, 2, 1) if in_flight % t == 0)
    place = f"{folder}/tier{tier}"

    def answers() -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return spark.read.schema("id string, answer string, failed string, batch int").parquet(place)
        except AnalysisException:  # nothing was answered yet
            return None

    known = answers()
    if known is not None:
        asked = asked.join(known.where("failed is null").select("id"), "id", "left_anti")
    if limit is not None:
        asked = asked.orderBy("id").limit(limit)
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("code")), F.lit(0))).first()
    first = 0 if known is None else (known.agg(F.max("batch")).first()[0] or 0) + 1

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(x: tuple) -> tuple:
            try:
                return x[0], model(tier, x[1]), None
            except Exception as e:  # noqa: BLE001  a call that fails is a result like any other
                return x[0], None, str(e)[:200]

        with ThreadPoolExecutor(threads) as pool:
            for part in parts:
                yield pd.DataFrame(pool.map(one, part.itertuples(index=False)), columns=["id", "answer", "failed"])

    parts = max(1, in_flight // threads)
    groups = max(1, -(-n // batch), -(-size // (PART_BYTES * parts)))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    dealt = f"{folder}/dealt{tier}"
    if groups > 1 and n:
        files = min(groups, max(1, size // PART_BYTES))  # of few texts one file has many groups
        asked.repartitionByRange(files, "group").sortWithinPartitions("group").write.mode("overwrite").parquet(dealt)
        asked = spark.read.parquet(dealt)
    for g in range(groups if n else 0):
        mine = asked.where(F.col("group") == g).select("id", "code").repartition(parts)
        mine.mapInPandas(run, "id string, answer string, failed string").write.mode("overwrite").parquet(f"{place}/batch={first + g}")
    if groups > 1 and n:
        hadoop.remove(spark, dealt)
    got = answers()
    if got is None:
        return chunks
    results = parsed_results(got.where("failed is null").groupBy("id").agg(F.max_by("answer", "batch").alias("answer")))
    return apply_tier_one(chunks, results) if tier == 1 else apply_tier_two(chunks, results)


#: The jobs of a sample, by tier.
JOBS = {1: {"classify": "classify_wrangle", "attrs": "extract_attributes", "funcs": "extract_functions", "bugs": "detect_bugs"}, 2: {"explain": "explain_code", "prompt": "generate_prompt"}}


def job_list(samples: DataFrame) -> DataFrame:
    """job_id, task_id, id, task, tier, priority, input: four jobs of the first tier and two of the second for each sample (id, code)."""
    jobs = F.array(*[F.struct(F.lit(suffix).alias("suffix"), F.lit(task).alias("task"), F.lit(t).alias("tier"), F.lit(1 - t).alias("priority")) for t, tasks in JOBS.items() for suffix, task in tasks.items()])
    rows = samples.select("id", "code", F.explode(jobs).alias("j"))
    name = F.concat_ws("_", "id", "j.suffix")
    return rows.select(name.alias("job_id"), name.alias("task_id"), "id", "j.task", "j.tier", "j.priority", F.col("code").alias("input"))


def run_two_tiers(samples: DataFrame, models: DataFrame, model: Model, gate: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Results of the first tier's jobs for all samples, and of the second's for those that the gate lets through (none: the unflagged ones)."""
    jobs = job_list(samples)
    first = call_models(route(jobs.where("tier = 1").drop("tier"), models), model)
    passing = gate(samples) if gate else unflagged(samples) if "flagged_for_review" in samples.columns else samples
    second = call_models(route(job_list(passing).where("tier = 2").drop("tier"), models), model)
    return first, second


def run_queue(jobs: DataFrame, models: DataFrame, model: Model, folder: str, most_retries: int = 3) -> DataFrame:
    """The last result of each job (job_id, task_id, task, input, priority and so on), with retries: a job that ends in error goes back into the queue up to so many times; one that
    no model serves fails at once. Each round's results are a table below a folder, and the next round begins from it.
    """
    spark, left, last = jobs.sparkSession, jobs, None
    for k in range(most_retries + 1):
        call_models(route(left, models), model).withColumn("retries", F.lit(k)).write.mode("overwrite").parquet(f"{folder}/round={k}")
        got = spark.read.parquet(f"{folder}/round={k}")
        again = got.where((F.col("status") == "error") & F.col("model_used").isNotNull()).select("task_id")
        ended = got if k == most_retries else got.join(again, "task_id", "left_anti")
        last = ended if last is None else last.unionByName(ended)
        left = left.join(again, "task_id", "left_semi")
        if k < most_retries and not again.limit(1).count():
            break
    return last


def job_table(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Jobs with the status of their result: pending, completed or failed, and its seconds."""
    got = results.select(F.col("task_id").alias("job_id"), "status", "result", "seconds")
    state = F.when(F.col("status").isNull(), "pending").when(F.col("status") == "success", "completed").otherwise("failed")
    return jobs.join(got, "job_id", "left").withColumn("state", state).drop("status")


def queue_stats(table: DataFrame) -> DataFrame:
    """One row: jobs, pending, completed, failed, average seconds of completed ones (0: none), jobs a minute."""
    seconds = F.coalesce(F.avg(F.when(F.col("state") == "completed", F.col("seconds"))), F.lit(0.0))
    n = lambda s: F.count_if(F.col("state") == s).alias(s)
    return table.agg(F.count("*").alias("total"), n("pending"), n("completed"), n("failed"), seconds.alias("avg_seconds"), F.when(seconds > 0, 60 / seconds).otherwise(0.0).alias("per_minute"))


def result_stream(results: DataFrame) -> Iterator[dict]:
    """Results one by one, a partition at a time on the driver."""
    for r in results.toLocalIterator(prefetchPartitions=True):
        yield r.asDict(recursive=True)


def ask(questions: DataFrame, samples: DataFrame, answer: Callable[[str], str], k: int = 3, use_corpus: bool = True) -> DataFrame:
    """question_id, prompt, answer: questions (question_id, question) answered by a function, with the k best samples by keyword search in the prompt; an error is its own answer."""
    if use_corpus:
        hits = keyword_search(samples, questions, k).join(samples.select("id", "code", "context", "topic"), "id")
        example = F.concat(F.lit("\n--- Example "), F.col("rank").cast("string"), F.lit(" ("), F.coalesce("context", F.lit("unknown")), F.lit(" context, "), F.coalesce("topic", F.lit("")), F.lit(") ---\n```\n"), F.coalesce("code", F.lit("")), F.lit("\n```\n"))
        shown = hits.groupBy("question_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", example.alias("e")))), lambda x: x["e"]), "").alias("examples"))
        asked = questions.join(shown, "question_id", "left")
    else:
        asked = questions.withColumn("examples", F.lit(None).cast("string"))
    prompt = F.when(F.col("examples").isNotNull(), F.concat("question", F.lit("\n\n\nRelevant examples from the corpus:\n"), "examples", F.lit("\nBased on these examples and your knowledge, please answer the question."))).otherwise(F.col("question"))

    @F.pandas_udf("string")
    def answered(prompts: pd.Series) -> pd.Series:
        def one(p: str) -> str:
            try:
                return answer(p)
            except Exception as e:  # noqa: BLE001
                return f"Error: {e}"

        return prompts.map(one)

    return asked.select("question_id", prompt.alias("prompt")).withColumn("answer", answered("prompt"))


def load_config(path: str) -> dict:
    """A model configuration from a YAML or JSON file; a file that is not there is an empty one."""
    from pathlib import Path

    file = Path(path)
    if not file.exists():
        return {}
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("a YAML configuration needs the yaml package; JSON does not") from e
    return yaml.safe_load(text) or {}


def model_table(spark: SparkSession, config: dict) -> DataFrame:
    """tier, model, fallbacks of a configuration."""
    rows = [(int(name.removeprefix("tier")), m.get("primary"), list(m.get("fallbacks") or [])) for name, m in (config.get("models") or {}).items() if name.startswith("tier")]
    return spark.createDataFrame(rows, "tier int, model string, fallbacks array<string>")


def voted_tasks(config: dict) -> list[str]:
    """Tasks that a configuration puts to a vote."""
    return [name for name, task in (config.get("tasks") or {}).items() if isinstance(task, dict) and task.get("consensus")]


#: The tasks that a stage puts to each sample.
STAGE_TASKS = {1: TIER_ONE, 2: ["generate_prompt", "explain_code", "rate_difficulty"]}


def _answered(samples: DataFrame, models: DataFrame, model: Model, tier: int) -> DataFrame:
    """Samples with __r and __c, maps of each task that succeeded to its result (JSON) and its confidence."""
    tasks = samples.select("id", F.col("code").alias("input"), F.explode(F.array(*map(F.lit, STAGE_TASKS[tier]))).alias("task"))
    got = call_models(route(tasks.withColumn("task_id", F.concat_ws("\u0001", "id", "task")), models), model).where("status = 'success'")
    named = got.select(F.substring_index("task_id", "\u0001", 1).alias("id"), "task", "result", "confidence")
    maps = [F.map_from_entries(F.collect_list(F.struct("task", c))).alias(name) for c, name in (("result", "__r"), ("confidence", "__c"))]
    return samples.join(named.groupBy("id").agg(*maps), "id", "left")


def _result(task: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(F.element_at("__r", F.lit(task))), path, kind)


def _columns(df: DataFrame, new: dict[str, tuple[str, Column, str]]) -> DataFrame:
    """new: column -> (task, value where the task succeeded, type); else what was there stays."""
    done = {c: F.when(F.element_at("__r", F.lit(task)).isNotNull(), value).otherwise(F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)) for c, (task, value, kind) in new.items()}
    return df.withColumns(done)


def tier_one_stage(samples: DataFrame, models: DataFrame, model: Model) -> DataFrame:
    """Samples (id, code) after six tasks each: context and its confidence, attributes, channels, functions, bugs, complexity, topic, and whether low confidence sends them to review."""
    names = lambda task, path: F.coalesce(_result(task, path, "array<string>"), _none())
    new = {
        "context": ("classify_wrangle", F.coalesce(_result("classify_wrangle", "$.context"), F.lit("unknown")), "string"),
        "context_confidence": ("classify_wrangle", F.element_at("__c", F.lit("classify_wrangle")), "double"),
        "attributes_read": ("extract_attributes", names("extract_attributes", "$.reads"), "array<string>"),
        "attributes_written": ("extract_attributes", names("extract_attributes", "$.writes"), "array<string>"),
        "channels": ("extract_attributes", names("extract_attributes", "$.channels"), "array<string>"),
        "functions": ("extract_functions", names("extract_functions", "$.functions"), "array<string>"),
        "bugs": ("detect_bugs", F.coalesce(_result("detect_bugs", "$.bugs", f"array<{BUG}>"), F.array().cast(f"array<{BUG}>")), f"array<{BUG}>"),
        "complexity": ("estimate_complexity", F.coalesce(_result("estimate_complexity", "$.complexity"), F.lit("")), "string"),
        "topic": ("classify_topic", F.coalesce(_result("classify_topic", "$.primary_topic"), F.lit("")), "string"),
    }
    out = _columns(_answered(samples, models, model, 1), new)
    sure = F.coalesce("context_confidence", F.lit(0.0))
    old = F.coalesce("flagged_for_review", F.lit(False)) if "flagged_for_review" in samples.columns else F.lit(False)
    reason = F.col("review_reason") if "review_reason" in samples.columns else F.lit("")
    low = sure < REVIEW_CONFIDENCE
    return out.withColumns({"context_confidence": sure, "flagged_for_review": old | low, "review_reason": F.when(low, F.concat(F.lit("Low context confidence: "), F.format_string("%.2f", sure))).otherwise(reason), "stage": F.lit("tier1")}).drop("__r", "__c")


def tier_two_stage(samples: DataFrame, models: DataFrame, model: Model) -> DataFrame:
    """Samples that are not flagged after three tasks each: prompt and its variants, explanation, difficulty; these are complete, flagged ones wait as they are."""
    new = {
        "prompt": ("generate_prompt", F.coalesce(_result("generate_prompt", "$.prompt"), F.lit("")), "string"),
        "alternative_prompts": ("generate_prompt", F.coalesce(_result("generate_prompt", "$.alternative_phrasings", "array<string>"), _none()), "array<string>"),
        "explanation": ("explain_code", F.coalesce(_result("explain_code", "$.explanation"), F.lit("")), "string"),
        "difficulty": ("rate_difficulty", F.coalesce(_result("rate_difficulty", "$.difficulty", "int"), F.lit(0)).cast("string"), "string"),
    }
    flagged = F.coalesce("flagged_for_review", F.lit(False)) if "flagged_for_review" in samples.columns else F.lit(False)
    done = _columns(_answered(samples.where(~flagged), models, model, 2), new).withColumn("stage", F.lit("complete")).drop("__r", "__c")
    return done.unionByName(samples.where(flagged), allowMissingColumns=True)
