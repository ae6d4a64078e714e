"""Model-backed steps: routing, calls with fallbacks, tolerant parsing, votes, gates. The model itself is a function that is passed in."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import packs as P
from ..functions.text import unfence

#: Tasks by tier, and those that are put to a vote.
TIER_ONE = ["classify_wrangle", "extract_attributes", "extract_functions", "detect_bugs", "estimate_complexity", "classify_topic"]
TIER_TWO = ["generate_prompt", "explain_code", "rate_difficulty", "suggest_fix", "paraphrase_prompt", "generate_variation"]
VOTED = ["detect_bugs", "estimate_complexity", "classify_topic", "rate_difficulty"]
REVIEW_CONFIDENCE, REVIEW_CONSENSUS = 0.6, 0.66


def tier(task: Column) -> Column:
    """Tier of a task; unknown tasks go to the first."""
    return F.when(task.isin(*TIER_TWO), 2).otherwise(1)


def route(tasks: DataFrame, models: DataFrame) -> DataFrame:
    """Tasks (column task) with their tier's models (tier, model, fallbacks; of several rows of a tier, the least). The two tiers' rows are sent to the tasks, which stay where they are."""
    one = models.where(F.col("tier").isin(1, 2)).groupBy("tier").agg(F.min(F.struct("model", "fallbacks")).alias("__m"))  # two rows at most
    return tasks.withColumn("tier", tier(F.col("task"))).join(F.broadcast(one.select("tier", "__m.model", "__m.fallbacks")), "tier", "left")


Model = Callable[[str, str, str], str]  # model name, task, input -> answer; raises TimeoutError, OSError or another error


STATUSES = ("success", "error", "uncertain")


def _parsed(answer: str) -> tuple[str, str | None, str | None, float]:
    """Status, result (JSON), error and confidence: an answer may say its status and confidence, and hold its result in a field of that name."""
    body = answer
    for fence in ("```json", "```"):
        if fence in body:
            body = body.split(fence, 1)[1].split("```", 1)[0]
            break
    try:
        got = json.loads(body.strip())
    except ValueError:
        return "error", None, f"parse: {answer[:200]}", 0.0
    if not isinstance(got, dict):
        return "error", None, f"parse: {answer[:200]}", 0.0
    said, sure = got.get("status"), got.get("confidence", 0.0)
    return said if said in STATUSES else "success", json.dumps(got.get("result", got), sort_keys=True, ensure_ascii=False), None, float(sure) if isinstance(sure, (int, float)) else 0.0


def call_models(routed: DataFrame, model: Model, retries: int = 2) -> DataFrame:
    """task_id, task, status, result (JSON), error, confidence, model_used, fallback_used, seconds: first the model, then its fallbacks, each with retries on errors in parsing."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                began, out = time.time(), ("error", None, "all_failed", 0.0)
                chain = [r.model, *(r.fallbacks if r.fallbacks is not None else [])] if r.model else []
                used = None
                for name in chain:
                    for _ in range(retries + 1):
                        try:
                            out = _parsed(model(name, r.task, r.input))
                        except TimeoutError:
                            out = ("error", None, "timeout", 0.0)
                        except OSError as e:
                            out = ("error", None, f"http: {e}"[:200], 0.0)
                        except Exception as e:  # noqa: BLE001  the taxonomy's last class
                            out = ("error", None, f"unknown: {e}"[:200], 0.0)
                        if out[0] == "success" or not (out[2] or "").startswith("parse"):
                            break
                    used = name
                    if out[0] == "success":
                        break
                rows.append((r.task_id, r.task, *out, used, bool(chain) and used != chain[0], time.time() - began))
            yield pd.DataFrame(rows, columns=["task_id", "task", "status", "result", "error", "confidence", "model_used", "fallback_used", "seconds"])

    return routed.select("task_id", "task", "input", "model", "fallbacks").mapInPandas(run, "task_id string, task string, status string, result string, error string, confidence double, model_used string, fallback_used boolean, seconds double")


def parse_answer(answer: Column) -> Column:
    """The answer as VARIANT, or null: fences are taken off first."""
    return F.try_parse_json(unfence(answer))


def vote_key(task: Column, result: Column) -> Column:
    """What is voted on, as text: by task a field of the result (VARIANT); difficulties in steps of 2, half to even; bug types sorted."""
    field = lambda path: F.try_variant_get(result, path, "string")
    number = F.try_variant_get(result, "$.difficulty", "double")
    bugs = F.array_join(F.array_sort(F.transform(F.try_variant_get(result, "$.bugs", "array<variant>"), lambda b: F.coalesce(F.try_variant_get(b, "$.type", "string"), F.lit("")))), ",")
    return (
        F.when(task == "classify_wrangle", field("$.context")).when(task == "classify_topic", field("$.primary_topic")).when(task == "estimate_complexity", field("$.complexity"))
        .when(task == "rate_difficulty", (F.bround(number / 2) * 2).cast("int").cast("string")).when(task == "detect_bugs", F.coalesce(bugs, F.lit("")))
    )


def consensus(votes: DataFrame) -> DataFrame:
    """task_id, winner, votes, asked, consensus. votes: task_id, ord, vote (null: none). Ties go to the vote seen first; the share is of all models asked."""
    asked = votes.groupBy("task_id").agg(F.count("*").alias("asked"))
    counts = votes.where("vote is not null").groupBy("task_id", "vote").agg(F.count("*").alias("votes"), F.min("ord").alias("seen"))
    best = counts.groupBy("task_id").agg(F.max_by(F.struct("vote", "votes"), F.struct("votes", -F.col("seen"))).alias("b"))
    return best.join(asked, "task_id").select("task_id", F.col("b.vote").alias("winner"), F.col("b.votes").alias("votes"), "asked", (F.col("b.votes") / F.col("asked")).alias("consensus"))


def needs_review(confidence: Column, consensus_: Column | None = None, status: Column | None = None) -> Column:
    """Low confidence, low consensus (none: full), or a status of error or uncertain."""
    out = F.coalesce(confidence, F.lit(0.0)) < REVIEW_CONFIDENCE
    if consensus_ is not None:
        out = out | (F.coalesce(consensus_, F.lit(1.0)) < REVIEW_CONSENSUS)
    return out if status is None else out | status.isin("error", "uncertain")


def review_reason(confidence: Column) -> Column:
    """Why a result goes to review, for low confidence (two places, halves up); else empty."""
    low = F.coalesce(confidence, F.lit(0.0))
    return F.when(low < REVIEW_CONFIDENCE, F.concat(F.lit("Low confidence: "), F.format_string("%.2f", low))).otherwise("")


def split_by_review(results: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """Results that pass, and those for review (a null flag passes)."""
    return results.where(~F.coalesce(flag, F.lit(False))), results.where(F.coalesce(flag, F.lit(False)))


def pending(samples: DataFrame, stage: str = "pending") -> DataFrame:
    """Samples that no stage has taken yet."""
    return samples.where(F.coalesce("stage", F.lit("pending")) == stage)


def unflagged(samples: DataFrame) -> DataFrame:
    """Samples that may go on to the second tier."""
    return samples.where(~F.coalesce("flagged_for_review", F.lit(False)))


def enriched(chunks: DataFrame) -> DataFrame:
    """Chunks that have a topic."""
    return chunks.where(F.coalesce("llm_topic", F.lit("")) != "")


def missing_models(required: list[str], available: list[str]) -> list[str]:
    """Required models that are not there, in their order."""
    return [m for m in dict.fromkeys(required) if m not in set(available)]


def needs_tier_one(code: Column, topic: Column) -> Column:
    return (F.length(code) >= 10) & (F.coalesce(topic, F.lit("")) == "")


def needs_tier_two(code: Column, prompt: Column, explanation: Column) -> Column:
    return (F.length(code) >= 10) & ((F.coalesce(prompt, F.lit("")) == "") | (F.coalesce(explanation, F.lit("")) == ""))


def fill_missing(old: Column, new: Column) -> Column:
    """Generated fields never overwrite."""
    return F.when(F.coalesce(old, F.lit("")) == "", new).otherwise(old)


def batch_stats(results: DataFrame) -> DataFrame:
    """total, success, error, avg_confidence (of successes, 3 places), avg_seconds, per_minute."""
    seconds = F.avg("seconds")
    return results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "error").alias("error"),
        F.round(F.avg(F.when(F.col("status") == "success", F.col("confidence"))), 3).alias("avg_confidence"), F.round(seconds, 3).alias("avg_seconds"), F.round(60 / seconds, 3).alias("per_minute"),
    )


def by_priority(jobs: DataFrame) -> DataFrame:
    """Jobs in the order of service: priority, then arrival (column ord). turn ascends in that order, with gaps; the sort is by ranges, over all tasks."""
    return jobs.orderBy(F.desc("priority"), "ord").withColumn("turn", F.monotonically_increasing_id())


def asked_models(routed: DataFrame, fallbacks: int = 2) -> DataFrame:
    """Of routed tasks that are put to a vote, one row for each model asked: the first, and so many of its fallbacks. ord is the place in that order."""
    chain = F.concat(F.array("model"), F.slice(F.coalesce("fallbacks", F.array().cast("array<string>")), 1, fallbacks))
    return routed.where(F.col("task").isin(*VOTED)).select("task_id", "task", "input", F.posexplode(chain).alias("ord", "model")).where("model is not null")


def vote(tasks: DataFrame, models: DataFrame, model: Model, fallbacks: int = 2) -> DataFrame:
    """task_id, winner, votes, asked, consensus, result: tasks answered by several models each; the result is the first (by model) of the winning vote."""
    asked = asked_models(route(tasks, models), fallbacks)
    one = asked.select(F.concat_ws("#", "task_id", F.col("ord").cast("string")).alias("task_id"), "task", "input", "model", F.array().cast("array<string>").alias("fallbacks"))
    got = call_models(one, model)
    name, place = F.substring_index("task_id", "#", -1).cast("int"), F.regexp_replace("task_id", "#[0-9]+$", "")
    keyed = got.select(place.alias("task_id"), name.alias("ord"), "result", vote_key(F.col("task"), F.try_parse_json("result")).alias("vote"))
    best = consensus(keyed)
    first = keyed.join(best.select("task_id", F.col("winner").alias("vote")), ["task_id", "vote"]).groupBy("task_id").agg(F.min_by("result", "ord").alias("result"))
    return best.join(first, "task_id", "left")


def declared_contexts() -> list[str]:
    return sorted({"sop", *P.CONTEXT_SIGNALS})
