"""More registered queries: stored indexes, reports and summaries, text projections, votes and jobs, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import code as C
from ..functions import packs as P
from ..functions import text as T
from ..operators import enrich, evaluate, export, graph, models, records, reports, search, segments, stats, vectors
from ..sources import files, hadoop
from . import catalog as c
from .catalog import ASKED, BM25, CALLS, CODED, DENSE, EDGES, JUDGED, STRIP, TOKENS, WARNED, coded, query, questions, read

# ---- the stored index


def _indexed(spark, sf, use):
    """What `use` reads from an index of documents, which is built in the shared folder and deleted again."""
    graph.shared_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/index-{uuid.uuid4().hex}"
    index = search.build_index(read(spark, sf, "documents"), "doc_id", F.col("text"), folder)
    out = use(index).checkpoint()
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return out


@query(f"WITH {ASKED}, {BM25} SELECT query_id, id, score, rank FROM r WHERE rank <= 20")
def index_search(spark, sf):
    return _indexed(spark, sf, lambda i: search.search_index(i, questions(spark), "query_id", F.col("query")))


@query(f"WITH {ASKED}, {BM25} SELECT query_id, id, score, rank FROM r WHERE rank <= 20")
def segment_search(spark, sf):
    """From an index that was changed until it holds the documents: some came with another text, some that are no documents came and went."""
    graph.shared_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/segments-{uuid.uuid4().hex}"
    docs, n = read(spark, sf, "documents").select("doc_id", "text"), F.col("doc_id")
    first = docs.where(n % 2 == 0).withColumn("text", F.when(n % 6 == 0, F.concat(F.lit("the trash "), F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    index = segments.add(segments.open_snapshot(spark, folder), first.unionByName(first.select((-1 - n).alias("doc_id"), "text")), "doc_id", F.col("text"))
    index = segments.add(index, docs.where((n % 2 != 0) | (n % 6 == 0)), "doc_id", F.col("text"))
    index = segments.delete(index, first.select((-1 - n).alias("id")))
    out = segments.search(index, questions(spark), "query_id", F.col("query"))[0].checkpoint()
    hadoop.remove(spark, folder)
    return out


@query(f"WITH {DENSE} SELECT query_id, id, score, rank FROM e WHERE rank <= 20")
def vector_index_search(spark, sf):
    """From a stored index of vectors; what dense_topk finds by a scan."""
    graph.shared_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/vectors-{uuid.uuid4().hex}"
    v = read(spark, sf, "embeddings")
    index = vectors.build_vectors(v, "vec_id", "embedding", folder)
    out = vectors.search_vectors(index, v.where("vec_id % 50 = 0"), "vec_id", "embedding", 20, 5)[0].checkpoint()
    hadoop.remove(spark, folder)
    return out


@query(f"SELECT t AS term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS t FROM documents) GROUP BY t")
def index_terms(spark, sf):
    return _indexed(spark, sf, lambda i: i.terms)


@query(f"SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS tokens, round(avg(len(t)), 6) AS avg_dl FROM (SELECT {TOKENS.format('text')} AS t FROM documents)")
def index_totals(spark, sf):
    return _indexed(spark, sf, lambda i: i.totals.withColumn("avg_dl", F.round("avg_dl", 6)))


@query(f"""WITH s AS (SELECT doc_id AS id, lower(code) AS code, lang AS context, source AS topic, {CALLS} AS calls, lower(text) AS prompt FROM (SELECT d.*, x.text FROM {CODED} d JOIN documents x USING (doc_id)) JOIN documents USING (doc_id, source, text)),
q AS (SELECT CAST(item_id AS VARCHAR) AS query, {c.WORDS.format('lower(text)')} AS terms FROM benchmark UNION ALL SELECT * FROM (VALUES ('k1', ['noise', 'on', '@p', 'noise']), ('k2', ['addpoint', 'fit']), ('k3', ['zzz', 'qqq']))),
z AS (SELECT query, id, 2 * len(list_filter(terms, lambda t: contains(code, t))) + 3 * CAST(len(list_filter(terms, lambda t: contains(context, t))) > 0 AS INTEGER) + 3 * CAST(len(list_filter(terms, lambda t: contains(topic, t))) > 0 AS INTEGER)
  + 4 * len(list_filter(calls, lambda f: len(list_filter(terms, lambda t: contains(lower(f), t))) > 0)) + 2 * CAST(len(list_filter(terms, lambda t: contains(prompt, t))) > 0 AS INTEGER) AS score FROM s, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM z WHERE score > 0)
SELECT query AS question_id, id, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def keyword_search(spark, sf):
    d = coded(spark, sf)
    samples = d.select(F.col("doc_id").alias("id"), "code", F.col("lang").alias("context"), F.col("source").alias("topic"), C.calls(F.col("code")).alias("calls"), F.col("text").alias("prompt"))
    asked = read(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("question_id"), F.col("text").alias("question"))
    own = spark.createDataFrame([("k1", "noise on @P Noise"), ("k2", "addpoint fit"), ("k3", "zzz qqq")], "question_id string, question string")
    return search.keyword_search(samples, asked.unionByName(own), 5)


# ---- evaluation

REQUIRED = [("Q1", ["noise"]), ("Q2", ["nosuchcall"]), ("Q3", []), ("Q4", ["addpoint", "fit"])]


@query(f"""WITH {ASKED}, {BM25} , made AS (SELECT doc_id AS id, {CALLS} AS calls FROM {CODED}), want(query_id, required) AS (VALUES {", ".join(f"('{a}', CAST({b} AS VARCHAR[]))" for a, b in REQUIRED)}),
h AS (SELECT r.query_id, bool_or(len(list_intersect(calls, required)) > 0) AS hit FROM r JOIN made USING (id) JOIN want ON want.query_id = r.query_id WHERE rank <= 20 GROUP BY r.query_id)
SELECT want.query_id, len(required) = 0 OR coalesce(hit, FALSE) AS has_required FROM want LEFT JOIN h USING (query_id)""")
def required_calls(spark, sf):
    calls = coded(spark, sf).select(F.col("doc_id").alias("id"), C.calls(F.col("code")).alias("calls"))
    return evaluate.has_required(c._bm25(spark, sf), calls, spark.createDataFrame(REQUIRED, "query_id string, required array<string>"))


# means of figures of 4 places, rounded half up in whole numbers
MEAN = ", ".join(f"(2 * CAST(sum(CAST(round({m} * 10000) AS BIGINT)) AS BIGINT) + count(*)) // (2 * count(*)) / 10000 AS {m}" for m in ("p_first", "p_all", "recall", "mrr", "ndcg", "ndcg_full"))


@query(f"WITH e AS ({c.SQL['eval_metrics']}) SELECT count(*) AS queries, {MEAN}, round(avg(CAST(verdict = 'PASS' AS DOUBLE)), 4) AS pass_rate FROM e")
def eval_summary(spark, sf):
    return evaluate.summary(c.eval_metrics(spark, sf))


# ---- text projections


@query(r"""SELECT doc_id, concat_ws(chr(10), nullif(lang, ''), nullif(text, ''), nullif(array_to_string(list_filter([CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, 'b'], lambda x: x <> ''), chr(10)), ''), CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'p' END) AS searchable,
regexp_replace(lower(concat_ws(' ', nullif(text, ''), CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END || ' b')), '^\s+|\s+$', '', 'g') AS comparable FROM documents""")
def record_texts(spark, sf):
    d = read(spark, sf, "documents")
    codes = F.array(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source")), F.lit("b"))
    prompt = F.when(F.col("doc_id") % 2 == 1, "p")
    return d.select("doc_id", T.searchable(F.col("lang"), F.col("text"), codes, F.lit(""), prompt, F.lit("")).alias("searchable"), T.comparable(F.col("text"), codes).alias("comparable"))


@query("""SELECT n, CASE WHEN n = 0 THEN 'Joy of VEX Index' WHEN n = 1 THEN 'HoudiniVex Tips' WHEN n = 2 THEN 'Other' ELSE 'Joy of VEX Day ' || n END AS label, CASE WHEN n = 1 THEN 'intermediate' WHEN n IN (0, 2) THEN 'beginner' WHEN n <= 5 THEN 'beginner' WHEN n <= 13 THEN 'intermediate' ELSE 'advanced' END AS difficulty,
  CASE WHEN n > 2 THEN n END AS episode FROM (SELECT DISTINCT event_id % 25 AS n FROM events)""")
def page_labels(spark, sf):
    n = F.col("n")
    e = read(spark, sf, "events").select((F.col("event_id") % 25).alias("n")).distinct()
    page = F.when(n == 0, "JoyOfVex").when(n == 1, "HoudiniVex").when(n == 2, "Other").otherwise(F.concat(F.lit("JoyOfVex"), F.lpad(n.cast("string"), 2, "0")))
    ident = F.when(n > 2, F.concat(F.lit("joy_of_vex_ep"), F.lpad(n.cast("string"), 2, "0"), F.lit("_1"))).otherwise("none")
    return e.select("n", T.section_label(page).alias("label"), T.page_difficulty(page).alias("difficulty"), T.episode(ident).alias("episode"))


@query(f"""WITH s AS (SELECT doc_id, {STRIP.format('code')} AS code, length(code) - length(replace(code, chr(10), '')) + 1 AS n FROM {CODED} WHERE {c._any('code', P.SNIPPET_MARKS)})
SELECT doc_id, CAST(2 AS INTEGER) AS source_line, code FROM s UNION ALL SELECT doc_id, CAST(5 + n AS INTEGER), code FROM s""")
def fence_samples(spark, sf):
    block = F.concat(F.col("code"), F.lit("\n```\n"))
    text = F.concat(F.lit("intro\n```vex\n"), block, F.lit("mid\n```\n"), block)
    return files.fence_samples(coded(spark, sf).select(F.col("doc_id").alias("path"), text.alias("text"))).select(F.col("path").alias("doc_id"), "source_line", "code")


@query("""WITH p AS (SELECT doc_id, contains(code, '@ptnum') OR contains(code, 'setpointattrib') AS a, contains(code, '@primnum') OR contains(code, 'primpoints') OR contains(code, 'setprimattrib') AS b, contains(code, '@vtxnum') OR contains(code, 'setvertexattrib') AS v,
  contains(code, 'setdetailattrib') AND NOT regexp_matches(code, '\\b(?:for|foreach|while)\\b') AS d, contains(code, '@P') OR contains(code, '@N') OR contains(code, '@Cd') AS w FROM """ + CODED + """)
SELECT doc_id, CASE WHEN CAST(a AS INTEGER) + CAST(b AS INTEGER) + CAST(v AS INTEGER) > 1 THEN 'unknown' WHEN a THEN 'point' WHEN b THEN 'prim' WHEN v THEN 'vertex' WHEN d THEN 'detail' WHEN w THEN 'point' ELSE 'unknown' END AS context FROM p""")
def snippet_contexts(spark, sf):
    return coded(spark, sf).select("doc_id", C.snippet_context(F.col("code")).alias("context"))


# ---- graph


@query(f"WITH {EDGES} SELECT d.doc_id, array_to_string(list_sort(list_distinct(list_concat(['c0_0'], coalesce(e.found, CAST([] AS VARCHAR[]))))), ',') AS prerequisites FROM documents d LEFT JOIN (SELECT src, list(DISTINCT dst) AS found FROM g GROUP BY src) e ON e.src = 'd' || d.doc_id")
def prerequisites(spark, sf):
    chunks = read(spark, sf, "documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.array(F.lit("c0_0")).alias("prerequisites"))
    return graph.merge_prerequisites(chunks, c._edges(spark, sf)).select("doc_id", F.array_join("prerequisites", ",").alias("prerequisites"))


# ---- reports

BLOCKS = f"(SELECT doc_id, content, code, {CALLS} AS calls, CASE WHEN doc_id % 4 = 0 THEN [] WHEN doc_id % 4 = 1 THEN [code, 'x;'] ELSE [code] END AS blocks FROM {CODED})"


def _blocks(spark, sf):
    n = F.col("doc_id") % 4
    block = lambda *xs: F.array(*[F.struct(x.alias("code")) for x in xs])
    none = F.array().cast("array<struct<code:string>>")
    return coded(spark, sf).select("doc_id", "content", "code", C.calls(F.col("code")).alias("functions_referenced"), F.when(n == 0, none).when(n == 1, block(F.col("code"), F.lit("x;"))).otherwise(block(F.col("code"))).alias("code_blocks"))


@query(f"""SELECT count(*) AS total_chunks, CAST(count_if(len(blocks) > 0) AS BIGINT) AS with_code, CAST(sum(len(blocks)) AS BIGINT) AS total_code_blocks, (SELECT count(DISTINCT f) FROM (SELECT unnest(calls) AS f FROM {BLOCKS})) AS unique_functions,
CAST(floor(sum(length(content) + coalesce(list_sum(list_transform(blocks, lambda b: length(b))), 0)) / count(*)) AS BIGINT) AS avg_chunk_length FROM {BLOCKS}""")
def corpus_report(spark, sf):
    return reports.corpus_stats(_blocks(spark, sf))


LLM = f"(SELECT doc_id, code, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS llm_topic, CASE WHEN doc_id % 4 > 0 THEN 'x' END AS llm_bugs, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'O(1)' END AS llm_complexity, CASE WHEN doc_id % 2 = 0 THEN 'p' ELSE '' END AS prompt, 'e' AS explanation FROM {CODED} JOIN documents USING (doc_id, source))"


def _llm(spark, sf):
    n = F.col("doc_id")
    return coded(spark, sf).select("doc_id", "code", F.when(n % 3 == 0, "").otherwise(F.col("lang")).alias("llm_topic"), F.when(n % 4 > 0, "x").alias("llm_bugs"), F.when(n % 5 != 0, "O(1)").alias("llm_complexity"), F.when(n % 2 == 0, "p").otherwise("").alias("prompt"), F.lit("e").alias("explanation"))


@query(f"""SELECT count(*) AS total_chunks, CAST(count_if(length(code) >= 10) AS BIGINT) AS with_code, CAST(count_if(llm_topic <> '') AS BIGINT) AS llm_topic, count(llm_bugs) AS llm_bugs, CAST(count_if(coalesce(llm_complexity, '') <> '') AS BIGINT) AS llm_complexity,
CAST(count_if(prompt <> '') AS BIGINT) AS prompt, CAST(count_if(explanation <> '') AS BIGINT) AS explanation FROM {LLM}""")
def cleaned_report(spark, sf):
    return reports.cleaned_stats(_llm(spark, sf), F.col("code"))


@query(f"SELECT llm_topic AS topic, count(*) AS n FROM {LLM} WHERE llm_topic <> '' GROUP BY 1")
def topic_distribution(spark, sf):
    return reports.topic_distribution(_llm(spark, sf))


@query(f"SELECT doc_id, 1 AS tier FROM {LLM} WHERE length(code) >= 10 AND llm_topic = '' UNION ALL SELECT doc_id, 2 FROM {LLM} WHERE length(code) >= 10 AND (prompt = '' OR explanation = '')")
def enrichment_requests(spark, sf):
    d = _llm(spark, sf).withColumn("id", F.col("doc_id"))
    parts = [enrich.requests(d, F.col("code"), t).select(F.col("id").alias("doc_id"), F.lit(t).alias("tier")) for t in (1, 2)]
    return parts[0].unionByName(parts[1])


TAGS = c.SQL["tag_merge_decisions"]


@query(f"""WITH t AS ({TAGS}) SELECT 'changed' AS measure, split_part(d, ':', 1) AS value, count(*) AS n FROM (SELECT unnest(string_split(decisions, '; ')) AS d FROM t WHERE decisions <> '') GROUP BY 2
UNION ALL SELECT 'content_type', content_type, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'difficulty', difficulty, count(*) FROM t GROUP BY 2
UNION ALL SELECT 'vex_context', x, count(*) FROM (SELECT unnest(string_split(contexts, ',')) AS x FROM t WHERE contexts <> '') GROUP BY 2 UNION ALL SELECT 'all', 'with_version', CAST(count_if(version <> '') AS BIGINT) FROM t""")
def tagging_summary(spark, sf):
    return reports.tagging_summary(c._tagged(spark, sf))


@query(f"SELECT d AS decision, count(*) AS n FROM (SELECT unnest(string_split(decisions, '; ')) AS d FROM ({TAGS}) WHERE decisions <> '') GROUP BY 1")
def decision_log(spark, sf):
    return reports.decision_log(c._tagged(spark, sf)).groupBy("decision").agg(F.count("*").alias("n"))


ENRICHED = f"(SELECT doc_id, len(list_distinct(list_concat(list_concat(['zz', 'abs'], CASE WHEN doc_id % 2 = 0 THEN ['noise'] ELSE CAST([] AS VARCHAR[]) END), {CALLS}))) AS f1, 2 + CAST(doc_id % 2 = 0 AS INTEGER) AS f0, 1 + len(list_filter(warnings, lambda w: w <> 'Unclosed braces: 1 more {{ than }}')) AS w1, {CALLS} AS calls FROM {WARNED})"


@query(f"""SELECT CAST(sum(f1) - sum(f0) AS BIGINT) AS functions_added, CAST(count_if(f1 > 0) AS BIGINT) AS chunks_with_functions, count(*) AS chunks, (SELECT count(DISTINCT f) FROM (SELECT unnest(list_concat(['zz', 'abs'], list_concat(CASE WHEN doc_id % 2 = 0 THEN ['noise'] ELSE CAST([] AS VARCHAR[]) END, calls))) AS f FROM {ENRICHED})) AS unique_functions,
CAST(sum(w1) - count(*) AS BIGINT) AS warnings_added FROM {ENRICHED}""")
def extraction_summary(spark, sf):
    return reports.extraction_summary(c._unextracted(spark, sf), c._extracted(spark, sf))


SAMPLES = f"(SELECT {c._LIST([*stats.STAGES, 'odd'])}[CAST(event_id % 8 AS INTEGER) + 1] AS stage, CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS context, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 't' || event_id % 3 END AS topic, CASE WHEN event_id % 4 > 0 THEN event_id % 4 = 1 END AS flagged, CASE WHEN event_id % 2 = 0 THEN 'p' ELSE '' END AS prompt FROM events)"


@query(f"""SELECT 'stage' AS measure, v.value, coalesce(n, 0) AS n FROM (SELECT unnest({c._LIST(stats.STAGES)}) AS value) v LEFT JOIN (SELECT stage, count(*) AS n FROM {SAMPLES} GROUP BY 1) s ON s.stage = v.value
UNION ALL SELECT 'context', coalesce(nullif(context, ''), 'unknown'), count(*) FROM {SAMPLES} GROUP BY 2 UNION ALL SELECT 'topic', coalesce(nullif(topic, ''), 'unknown'), count(*) FROM {SAMPLES} GROUP BY 2
UNION ALL SELECT 'all', 'total', count(*) FROM {SAMPLES} UNION ALL SELECT 'all', 'flagged_for_review', CAST(count_if(coalesce(flagged, FALSE)) AS BIGINT) FROM {SAMPLES} UNION ALL SELECT 'all', 'with_prompts', CAST(count_if(prompt <> '') AS BIGINT) FROM {SAMPLES}""")
def stage_report(spark, sf):
    n = F.col("event_id")
    stage = F.element_at(F.array(*map(F.lit, [*stats.STAGES, "odd"])), (n % 8).cast("int") + 1)
    s = read(spark, sf, "events").select(
        stage.alias("stage"), F.when(n % 5 == 0, "").otherwise(F.col("event_type")).alias("context"), F.when(n % 7 != 0, F.concat(F.lit("t"), (n % 3).cast("string"))).alias("topic"),
        F.when(n % 4 > 0, n % 4 == 1).alias("flagged_for_review"), F.when(n % 2 == 0, "p").otherwise("").alias("prompt"),
    )
    return reports.stage_report(s)


@query("SELECT 'm' || user_id % 5 AS model, round(avg(value), 3) AS avg_seconds, round(avg(value * 2), 3) AS avg_rate, round(avg(CAST(event_id % 4 <> 0 AS DOUBLE)), 4) AS success_rate FROM events GROUP BY 1")
def model_summary(spark, sf):
    e = read(spark, sf, "events")
    return reports.model_summary(e.select(F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("model"), F.col("value").alias("seconds"), (F.col("value") * 2).alias("tokens_per_sec"), (F.col("event_id") % 4 != 0).alias("success")))


@query("SELECT event_type AS worker, CAST(count_if(event_id % 6 <> 0) AS BIGINT) AS processed, CAST(count_if(event_id % 6 = 0) AS BIGINT) AS failed, round(avg(value) FILTER (event_id % 6 <> 0), 3) AS avg_ms, round(CAST(count_if(event_id % 6 <> 0) AS DOUBLE) / count(*), 4) AS success_rate FROM events GROUP BY 1")
def worker_summary(spark, sf):
    return reports.worker_summary(read(spark, sf, "events").select(F.col("event_type").alias("worker"), (F.col("event_id") % 6 != 0).alias("ok"), F.col("value").alias("ms")))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events) WHERE r <= 20")
def recent_errors(spark, sf):
    return reports.recent(read(spark, sf, "events").select("event_id", "event_type"), "event_id", 20, "event_type").select("event_id")


@query("SELECT 'difficulty' AS measure, CAST(event_id % 10 AS VARCHAR) AS value, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'all', 'flagged_for_review', CAST(count_if(event_id % 9 = 0) AS BIGINT) FROM events")
def import_summary(spark, sf):
    return reports.import_summary(read(spark, sf, "events").select((F.col("event_id") % 10).alias("difficulty"), (F.col("event_id") % 9 == 0).alias("flagged_for_review")))


@query(rf"""WITH r AS (SELECT doc_id, {STRIP.format("text || CASE WHEN doc_id % 2 = 0 THEN ' @Cd = @P; chf(1) chs(2)  ' ELSE chr(10) || '@N += 1 ' END")} AS code FROM documents),
k AS (SELECT *, substr(sha256(code), 1, 16) AS h, row_number() OVER (PARTITION BY sha256(code) ORDER BY doc_id) AS n FROM r WHERE code <> ''), s AS (SELECT *, len(code) - len(replace(code, chr(10), '')) + 1 AS lines, CASE WHEN doc_id % 4 = 0 THEN 3 WHEN doc_id % 4 = 1 THEN 1 ELSE 0 END AS calls FROM k WHERE n = 1)
SELECT CASE WHEN doc_id % 3 = 0 THEN 'vex_' || h ELSE CAST(doc_id AS VARCHAR) END AS id, h AS hash, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(code, '@(\w+)', 1), lambda a: NOT list_contains(regexp_extract_all(code, '@(\w+)\s*=', 1), a)))), ',') AS read,
  array_to_string(list_sort(list_distinct(regexp_extract_all(code, '@(\w+)\s*=', 1))), ',') AS written, array_to_string(regexp_extract_all(code, 'ch[fivs]\(|chramp\('), ',') AS channels,
  CASE WHEN lines <= 2 AND calls <= 2 THEN 'simple' WHEN lines <= 8 AND calls <= 5 THEN 'moderate' ELSE 'complex' END AS complexity, CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 3 END AS difficulty, doc_id % 9 = 0 AS flagged FROM s""")
def imported_samples(spark, sf):
    n = F.col("doc_id")
    raw = read(spark, sf, "documents").select(
        n.alias("ord"), F.when(n % 3 != 0, n.cast("string")).alias("id"), F.concat("text", F.when(n % 2 == 0, " @Cd = @P; chf(1) chs(2)  ").otherwise("\n@N += 1 ")).alias("code"),
        F.when(n % 5 == 0, "beginner").when(n % 5 == 1, "advanced").when(n % 5 == 2, "odd").alias("difficulty"), (n % 9 == 0).alias("needs_review"),
        F.when(n % 4 == 0, F.array(*map(F.lit, ["a", "b", "@P", "c"]))).when(n % 4 == 1, F.array(F.lit("noise"))).alias("vex_functions"),
    )
    got = records.import_records(raw)
    return got.select("id", "hash", *[F.array_join(c, ",").alias(name) for name, c in (("read", "attributes_read"), ("written", "attributes_written"), ("channels", "channels"))], "complexity", "difficulty", F.col("flagged_for_review").alias("flagged"))


@query("""SELECT d.doc_id || '_' || suffix AS job_id, task, CAST(tier AS INTEGER) AS tier, CAST(1 - tier AS INTEGER) AS priority FROM documents d, (VALUES ('classify', 'classify_wrangle', 1), ('attrs', 'extract_attributes', 1), ('funcs', 'extract_functions', 1), ('bugs', 'detect_bugs', 1), ('explain', 'explain_code', 2), ('prompt', 'generate_prompt', 2)) j(suffix, task, tier)""")
def job_list(spark, sf):
    return enrich.job_list(read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("code"))).select("job_id", "task", "tier", "priority")


@query("""SELECT user_id || '' AS task_id, [ 'm1', 'm2', 'm3', 'm4' ][CAST(i AS INTEGER) + 1] AS model, CAST(i AS INTEGER) AS ord FROM (SELECT DISTINCT user_id FROM events), (VALUES (0), (1), (2)) v(i) WHERE user_id % 4 IN (0, 1)""")
def asked_models(spark, sf):
    tasks = read(spark, sf, "events").select("user_id").distinct().select(F.col("user_id").cast("string").alias("task_id"), F.element_at(F.array(*map(F.lit, ["classify_topic", "detect_bugs", "explain_code", "anything"])), (F.col("user_id") % 4).cast("int") + 1).alias("task"), F.lit("x").alias("input"))
    known = spark.createDataFrame([(1, "m1", ["m2", "m3", "m4"]), (2, "m9", [])], "tier int, model string, fallbacks array<string>")
    return models.asked_models(models.route(tasks, known)).select("task_id", "model", "ord")


@query(r"""WITH c AS (SELECT lang AS topic, doc_id, CASE doc_id % 3 WHEN 0 THEN 'beginner' WHEN 1 THEN 'expert' ELSE 'unknown' END AS level, source, regexp_replace(string_split(text, '. ')[1], '\.+$', '') AS h FROM documents)
SELECT topic, level, CAST(CASE level WHEN 'beginner' THEN 0 WHEN 'expert' THEN 3 ELSE 4 END AS INTEGER) AS rank, source AS source_id, 'd' || doc_id AS id, '### T' || doc_id || chr(10) || chr(10) || (CASE WHEN length(h) > 200 THEN substr(h, 1, 197) || '...' ELSE h END) || '.' || chr(10) || chr(10) AS entry FROM c""")
def topic_entries(spark, sf):
    ident = F.col("doc_id").cast("string")
    level = F.when(F.col("doc_id") % 3 == 0, "beginner").when(F.col("doc_id") % 3 == 1, "expert")
    d = read(spark, sf, "documents")
    return export.topic_entries(d.select(F.col("lang").alias("topic"), F.concat(F.lit("d"), ident).alias("id"), F.concat(F.lit("T"), ident).alias("title"), level.alias("difficulty"), F.col("source").alias("source_id"), F.lit("").alias("code"), F.col("text").alias("content")))


@query(r"""WITH k AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'edge_ops' ELSE 'misc_' || lang END AS topic, CASE doc_id % 3 WHEN 0 THEN 'expert' WHEN 1 THEN 'beginner' END AS level, doc_id, source, text FROM documents),
e AS (SELECT topic, coalesce(list_position(['beginner', 'intermediate', 'advanced', 'expert'], level), 5) AS r, source, 'd' || doc_id AS id, '### T' || doc_id || chr(10) || chr(10) || (CASE WHEN length(h) > 200 THEN substr(h, 1, 197) || '...' ELSE h END) || '.' || chr(10) || chr(10) AS e FROM (SELECT *, regexp_replace(string_split(text, '. ')[1], '\.+$', '') AS h FROM k)),
s AS (SELECT topic, '## ' || array_to_string(list_transform(string_split(topic, '_'), lambda p: upper(p[1]) || p[2:]), ' ') || ' (' || count(*) || ' examples)' || chr(10) || chr(10) || string_agg(e, '' ORDER BY r, source, id) AS t FROM e GROUP BY topic)
SELECT '# Corpus: Miscellaneous Topics' || chr(10) || chr(10) || '> ' || (SELECT count(*) FROM k) || ' examples from corpus (small topics). Sources: ' || (SELECT array_to_string(list_sort(list(DISTINCT source)), ', ') FROM k) || chr(10) || chr(10) || string_agg(t, '' ORDER BY topic) AS page FROM s""")
def misc_page(spark, sf):
    n = F.col("doc_id")
    ident = n.cast("string")
    topic = F.when(n % 2 == 0, "edge_ops").otherwise(F.concat(F.lit("misc_"), "lang"))
    d = read(spark, sf, "documents")
    return export.misc_page(d.select(topic.alias("topic"), F.concat(F.lit("d"), ident).alias("id"), F.concat(F.lit("T"), ident).alias("title"), F.when(n % 3 == 0, "expert").when(n % 3 == 1, "beginner").alias("difficulty"), F.col("source").alias("source_id"), F.lit("").alias("code"), F.col("text").alias("content")))


@query(f"WITH {JUDGED} SELECT query_id, count(*) AS n FROM rel GROUP BY query_id")
def relevance_counts(spark, sf):
    patterns = spark.createDataFrame(c.PATTERNS, "query_id string, patterns array<string>")
    return evaluate.judged(read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), F.col("text"), patterns).groupBy("query_id").agg(F.count("*").alias("n"))
