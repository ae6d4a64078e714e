"""Registered queries of the steps that models answer, each with its SQL. The models here are plain functions of a text's length, so what must come out is known."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import code as C
from ..functions import text as T
from ..operators import enrich, graph, models
from ..sources import hadoop
from . import reports  # noqa: F401  keyword_search's SQL is registered there
from .catalog import CODED, SQL, STRIP, coded, query, read


def _documents(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("input"))


SIZED = "d AS (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents)"


def _in_folder(spark, use):
    """What `use` makes below a folder of the shared one, which is removed again."""
    graph.shared_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/answers-{uuid.uuid4().hex}"
    out = use(folder).checkpoint()
    hadoop.remove(spark, folder)
    return out


def _fickle(name: str, task: str, text: str) -> str:
    """Fails in each way that is told apart, and answers in each shape."""
    n = len(text) % 7
    if name == "one" and n in (0, 1, 3):
        raise {0: TimeoutError(), 1: OSError("down"), 3: ValueError("odd")}[n]
    if n == 2:
        return "no json"
    said = json.dumps({"confidence": n / 10, "result": {"n": n}} | ({"status": "uncertain"} if n == 6 else {}))
    return f"Here it is:\n```json\n{said}\n``` as asked" if n == 5 else said


def _served(spark):
    return spark.createDataFrame([(1, "one", ["two"]), (2, "three", [])], "tier int, model string, fallbacks array<string>")


@query(f"""WITH {SIZED}, s AS (SELECT doc_id, n % 7 AS n, doc_id % 2 = 0 AS first FROM d)
SELECT doc_id, CASE n WHEN 2 THEN 'error' WHEN 6 THEN 'uncertain' ELSE 'success' END AS status, CASE WHEN n <> 2 THEN '{{"n": ' || n || '}}' END AS result, CASE WHEN n = 2 THEN 'parse: no json' END AS error,
  CASE WHEN n = 2 THEN 0e0 ELSE n / 10e0 END AS confidence, CASE WHEN NOT first THEN 'three' WHEN n IN (4, 5) THEN 'one' ELSE 'two' END AS model_used, first AND n NOT IN (4, 5) AS fallback_used FROM s""")
def model_answers(spark, sf):
    task = F.when(F.col("doc_id") % 2 == 0, "classify_topic").otherwise("explain_code")
    tasks = _documents(spark, sf).select(F.col("doc_id").cast("string").alias("task_id"), task.alias("task"), "input")
    got = models.call_models(models.route(tasks, _served(spark)), _fickle)
    return got.select(F.col("task_id").cast("long").alias("doc_id"), "status", "result", "error", "confidence", "model_used", "fallback_used")


def _voter(name: str, task: str, text: str) -> str:
    n = len(text) + {"a": 0, "b": 1, "c": 5}[name]
    return json.dumps({"result": {"difficulty": n % 10} if task == "rate_difficulty" else {"primary_topic": "x" if n % 3 == 0 else name}})


@query(f"""WITH {SIZED}, m(ord, model, more) AS (VALUES (0, 'a', 0), (1, 'b', 1), (2, 'c', 5)), v AS (SELECT doc_id, ord, n + more AS n, model FROM d, m),
k AS (SELECT doc_id, ord, CASE WHEN doc_id % 2 = 0 THEN CAST(CAST(round_even(n % 10 / 2e0, 0) * 2 AS INTEGER) AS VARCHAR) WHEN n % 3 = 0 THEN 'x' ELSE model END AS vote,
  CASE WHEN doc_id % 2 = 0 THEN '{{"difficulty": ' || (n % 10) || '}}' ELSE '{{"primary_topic": "' || CASE WHEN n % 3 = 0 THEN 'x' ELSE model END || '"}}' END AS result FROM v),
c AS (SELECT doc_id, vote, count(*) AS votes, min(ord) AS seen, arg_min(result, ord) AS result FROM k GROUP BY doc_id, vote), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, seen) AS r FROM c)
SELECT doc_id, vote AS winner, votes, CAST(3 AS BIGINT) AS asked, votes / 3e0 AS consensus, result FROM b WHERE r = 1""")
def voted_answers(spark, sf):
    task = F.when(F.col("doc_id") % 2 == 0, "rate_difficulty").otherwise("classify_topic")
    tasks = _documents(spark, sf).select(F.col("doc_id").cast("string").alias("task_id"), task.alias("task"), "input")
    chain = spark.createDataFrame([(1, "a", ["b", "c", "d"]), (2, "a", ["b", "c"])], "tier int, model string, fallbacks array<string>")
    return models.vote(tasks, chain, _voter).select(F.col("task_id").cast("long").alias("doc_id"), "winner", "votes", "asked", "consensus", "result")


def _shapes(tier: int, code: str) -> str:
    """A combined answer in each of the shapes that are taken."""
    return (
        '{"topic": "a", "bugs": [], "complexity": "low"}',
        '```json\n{"topic": {"primary": "b", "secondary": ["c"]}, "bugs": {"issues": [{"type": "t", "severity": "s"}], "quality": "bad"}, "complexity": {"class": "high", "bottlenecks": ["loop", "wrangle"]}}\n```',
        '{"topic": {"primary_topic": "d", "secondary_topics": ["e", "f"]}, "bugs": {"bugs": [{"type": "u"}], "overall_quality": "fine"}, "complexity": {"complexity": "mid"}}',
        '{"topic": "g", "bugs": [{"type": "u"}, {"type": "v"}]}',
        "broken {",
    )[len(code) % 5]


@query("""WITH s AS (SELECT doc_id, text, CASE WHEN doc_id % 6 = 0 THEN 'known' END AS topic, CASE WHEN doc_id % 6 <> 0 AND length(text) >= 10 THEN length(text) % 5 END AS k FROM documents)
SELECT doc_id, coalesce(['a', 'b', 'd', 'g'][k + 1], topic) AS topic, ['clean', 'bad', 'fine', 'minor_issues'][k + 1] AS quality, ['low', 'high', 'mid', 'unknown'][k + 1] AS complexity, ['', 'c', 'e,f', ''][k + 1] AS secondary,
  CAST([0, 1, 1, 2][k + 1] AS INTEGER) AS n_bugs, ['', 'loop,wrangle', '', ''][k + 1] AS bottlenecks FROM s""")
def enriched_documents(spark, sf):
    """Chunks enriched by one combined call each; those with a topic, without code, or with an answer that is no JSON stay as they are."""
    chunks = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", F.when(F.col("doc_id") % 6 == 0, "known").alias("llm_topic"))
    got = _in_folder(spark, lambda folder: enrich.enrich(chunks, F.col("text"), _shapes, folder, 1, batch=1 << 40))
    joined = lambda c: F.array_join(c, ",")
    return got.select(F.col("id").cast("long").alias("doc_id"), F.col("llm_topic").alias("topic"), F.col("llm_code_quality").alias("quality"), F.col("llm_complexity").alias("complexity"), joined("llm_secondary_topics").alias("secondary"), F.when(F.col("llm_bugs").isNotNull(), F.size("llm_bugs")).alias("n_bugs"), joined("llm_bottlenecks").alias("bottlenecks"))


def _down(name: str, task: str, text: str) -> str:
    if len(text) % 3 == 0:
        raise OSError("down")
    return '{"ok": true}'


@query(f"""WITH {SIZED} SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR n % 3 = 0 THEN 'error' ELSE 'success' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'all_failed' WHEN n % 3 = 0 THEN 'http: down' END AS error,
  CASE WHEN doc_id % 5 <> 0 AND n % 3 = 0 THEN 2 ELSE 0 END AS retries, CASE WHEN doc_id % 5 = 0 OR n % 3 = 0 THEN 'failed' ELSE 'completed' END AS state FROM d""")
def retried_jobs(spark, sf):
    """Jobs in error go back into the queue twice; those that no model serves fail at once."""
    task = F.when(F.col("doc_id") % 5 == 0, "explain_code").otherwise("detect_bugs")
    jobs = _documents(spark, sf).select(F.col("doc_id").cast("string").alias("task_id"), task.alias("task"), "input").withColumn("job_id", F.col("task_id"))
    served = spark.createDataFrame([(1, "one", [])], "tier int, model string, fallbacks array<string>")
    got = _in_folder(spark, lambda folder: enrich.run_queue(jobs, served, _down, folder, 2))
    told = enrich.job_table(jobs, got).select("job_id", "state")
    return got.select(F.col("task_id").alias("job_id"), "status", "error", "retries").join(told, "job_id").select(F.col("job_id").cast("long").alias("doc_id"), "status", "error", F.col("retries").cast("int").alias("retries"), "state")


@query(f"""WITH {SIZED}, t(task, tier) AS (VALUES ('classify_wrangle', 1), ('extract_attributes', 1), ('extract_functions', 1), ('detect_bugs', 1), ('explain_code', 2), ('generate_prompt', 2))
SELECT task, CASE WHEN n % 3 = 0 THEN 'error' ELSE 'success' END AS status, count(*) AS n FROM d, t WHERE tier = 1 OR doc_id % 4 <> 0 GROUP BY 1, 2""")
def two_tier_jobs(spark, sf):
    """Four jobs of the first tier for each document, and two of the second for those that are not flagged."""
    samples = _documents(spark, sf).select(F.col("doc_id").cast("string").alias("id"), F.col("input").alias("code"), (F.col("doc_id") % 4 == 0).alias("flagged_for_review"))
    first, second = enrich.run_two_tiers(samples, _served(spark), _down)
    return first.unionByName(second).groupBy("task", "status").agg(F.count("*").alias("n"))


@query(f"""WITH h AS ({SQL['keyword_search']}), q AS (SELECT CAST(item_id AS VARCHAR) AS question_id, text AS question FROM benchmark UNION ALL SELECT * FROM (VALUES ('k1', 'noise on @P Noise'), ('k2', 'addpoint fit'), ('k3', 'zzz qqq'))),
e AS (SELECT question_id, string_agg(chr(10) || '--- Example ' || rank || ' (' || coalesce(lang, 'unknown') || ' context, ' || coalesce(d.source, '') || ') ---' || chr(10) || '```' || chr(10) || coalesce(x.code, '') || chr(10) || '```' || chr(10), '' ORDER BY rank) AS examples
  FROM h JOIN documents d ON h.id = d.doc_id JOIN (SELECT doc_id, code FROM {CODED}) x ON x.doc_id = h.id WHERE rank <= 3 GROUP BY question_id),
p AS (SELECT q.question_id, CASE WHEN examples IS NULL THEN question ELSE question || repeat(chr(10), 3) || 'Relevant examples from the corpus:' || chr(10) || examples || chr(10) || 'Based on these examples and your knowledge, please answer the question.' END AS prompt FROM q LEFT JOIN e USING (question_id))
SELECT question_id, prompt, 'of ' || length(prompt) AS answer FROM p""")
def asked_questions(spark, sf):
    """Questions answered with the best samples of the corpus in their prompts."""
    d = coded(spark, sf)
    samples = d.select(F.col("doc_id").alias("id"), "code", F.col("lang").alias("context"), F.col("source").alias("topic"), C.calls(F.col("code")).alias("calls"), F.col("text").alias("prompt"))
    asked = read(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("question_id"), F.col("text").alias("question"))
    own = spark.createDataFrame([("k1", "noise on @P Noise"), ("k2", "addpoint fit"), ("k3", "zzz qqq")], "question_id string, question string")
    return enrich.ask(asked.unionByName(own), samples, lambda prompt: f"of {len(prompt)}")


# ---- small forms of text


@query(f"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN {STRIP.format("split_part(text, '`', 1)")} WHEN doc_id % 4 = 1 THEN 'plain' WHEN doc_id % 4 = 2 THEN '[1]' ELSE {STRIP.format('text')} END AS body,
  regexp_extract(CASE WHEN doc_id % 3 = 0 THEN 'float[] f(' WHEN doc_id % 3 = 1 THEN 'vector  noise2 (int a)' ELSE 'noise(' END || text, '^(\\w+(?:\\[\\])?)\\s+\\w+\\s*\\(', 1) AS returns,
  'page_' || CASE WHEN doc_id < 1000 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE CAST(doc_id AS VARCHAR) END AS page, text || ';' || chr(10) || coalesce(CASE WHEN doc_id % 2 = 0 THEN '@Cd' END || chr(10), '') || lang AS code,
  {STRIP.format("text || ' ' || chr(10) || lang")} AS prompted FROM documents WHERE text NOT LIKE '%```%'""")
def text_forms(spark, sf):
    """What is fenced in answers, the types of signatures, padded ids, and all code of a record as a checker and as a prompt take it."""
    n, text = F.col("doc_id"), F.col("text")
    d = read(spark, sf, "documents").where(~F.contains("text", F.lit("```")))
    answer = F.when(n % 4 == 0, F.concat(F.lit("so ```json\n"), F.element_at(F.split(text, "`", -1), 1), F.lit("\n``` or ```x```"))).when(n % 4 == 1, F.concat(F.lit("``` plain ```"), text)).when(n % 4 == 2, F.concat(F.lit("```x``` ```json [1]"), F.lit(""))).otherwise(text)
    head = F.concat(F.when(n % 3 == 0, "float[] f(").when(n % 3 == 1, "vector  noise2 (int a)").otherwise("noise("), text)
    blocks = F.when(n % 2 == 0, F.array(F.concat(text, F.lit(";")), F.lit("@Cd"))).otherwise(F.array(F.concat(text, F.lit(";"))))
    return d.select(
        "doc_id", T.unfence(answer).alias("body"), T.return_type(head).alias("returns"), T.sequence_id(F.lit("page"), n).alias("page"), C.joined_code("\n", blocks, F.col("lang")).alias("code"),
        C.joined_code("\n", F.array(F.concat(text, F.lit(" "))), F.col("lang"), stripped=True).alias("prompted"),
    )


@query("SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_id) AS INTEGER) AS served FROM events")
def service_order(spark, sf):
    """Each user's jobs in the order in which a queue serves them."""
    jobs = models.by_priority(read(spark, sf, "events").select("event_id", "user_id", (F.col("event_id") % 3).alias("priority"), F.col("event_id").alias("ord")))
    return jobs.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("turn")).alias("served"))
