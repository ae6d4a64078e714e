"""The registered queries of the engine, each with the SQL that must give the same rows.

Every query reads whole tables. SQL for the rule packs is generated from the same tables of fixed values, since these are data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import code as C
from ..functions import identity, rules
from ..functions import packs as P
from ..functions import text as T
from ..operators import dedup, evaluate, export, graph, models, records, search, stats
from ..sources import files, html
from ..streaming import flush, streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(text: str, signals: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {_q(s)})" for s in signals) + ")"


def _count(text: str, signals: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, {_q(s)}) AS INTEGER)" for s in signals) + ")"


def _rany(text: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {_q(p)})" for p in patterns) + ")"


def _rcount(text: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"CAST(regexp_matches({text}, {_q(p)}) AS INTEGER)" for p in patterns) + ")"


STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
TOKENS = r"list_filter(regexp_extract_all(lower({0}), '@?[\p{{L}}\p{{N}}_]+'), lambda t: length(t) > 1 OR starts_with(t, '@'))"
WORDS = r"list_filter(string_split_regex({0}, '\s+'), lambda w: w <> '')"
SHINGLES = """list_distinct(list_concat(
    CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) ELSE CAST([] AS VARCHAR[]) END,
    CASE WHEN len(w) < 10 THEN w ELSE CAST([] AS VARCHAR[]) END))"""
SETS = f"""sets AS (SELECT id, {SHINGLES} AS s FROM (SELECT doc_id AS id, {WORDS.format("lower(text)")} AS w FROM documents) WHERE len(w) >= 3)"""
#: The source's number stands for its authority.
AUTHORITY = "CAST(CAST(substr(source, 4) AS INTEGER) % 7 AS DOUBLE) / 10"


def authority(c: str = "source"):
    return (F.substring(c, 4, 9).cast("int") % 7).cast("double") / 10


#: Snippets that are laid before texts by id, so that every class, rule and tie of the rule packs occurs.
SNIPPETS = [
    "", "short", "v@P += noise(@P) * 2;\n@Cd = hsvtorgb(@Time, 1, 1);", "int h = pcopen(0, 'P', @P, 1, 10); foreach (int p; nearpoints(0, @P, 1)) { removepoint(0, p); }", "float a = ch('amp') ; float b = chramp(\"r\", a);\nAbs(a); Dot(a, b); Solver(1); normalize(Vector(a))",
    "matrix3 m = ident(); rotate(m, 1, {0,1,0}); vector4 q = quaternion(m); slerp(q, q, 0.5) ", "int pt = addpoint(0, @P); addprim(0, 'polyline', pt", "for (int i = 0; i < 3; i++) { setpointattrib(0, 'a', i, 1) }\nint x = 1", "vertexpoint(0, 1) + hedge_next(0, 1); neighbours(0, 1)",
    "fit(clamp(sin(@P.x), 0, 1), 0, 1, 0, 1) + pow(2, 3)", "if (@ptnum == 0) { @Cd = 1; } else { @Cd = 0; }", "f = solver(prev_frame) + @Frame; dopfield(0)", "string s = sprintf('%d', 1); split(s); join({}, '')", "advect(curlnoise(@P)); streamline(1)",
    "cinput(0, @IX, @IY) + @IR", "chinput(0) * sample_rate + @Channel", "cvex_bsdf(1) + renderstate('a') + gather(1)", "texture('a.jpg', @uv) + diffuse(nrm)", "@opinput1_P + osd_limitSurface(0) + usd_attrib(0) ; getglobalvariable('x')", "foreach (int i; array) { pcfind_radius(0); detailintrinsic(0, 'b'); inpointgroup(0, 'g', 1); }",
    "dict d; setprimintrinsic(0, 'a', 0, 1); instance(1); @ptnum = 3; @numpt =1;", "how to setup the workflow, step 1 first then next", "the signature returns type and syntax of it", "there is an error and a bug and a problem that is not working", "personally i think this forum has a question and an answer", "an introduction: what is the basic concept",
    "}} ) @numprim == 4\n// a = comment\ny = 2", "volumesample(0, 0, @P) + @voxelsize; Luminance(1); Length(x)", "thread and compile opencl", "chv('c'); ramp and lerp(1, 2, 3) detail(0, 'a', 0)",
    "setprimattrib(0, 'a', 0, 1); primpoints(0, 1);", "setvertexattrib(0, 'a', 0, 1);", "setdetailattrib(0, 'n', 1);", "foreach (int i; a) { setdetailattrib(0, 'n', i); }",
]
PLANTED = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in SNIPPETS) + f"][CAST(doc_id % {len(SNIPPETS)} AS INTEGER) + 1]"


def planted() -> Column:
    return F.element_at(F.array(*map(F.lit, SNIPPETS)), (F.col("doc_id") % len(SNIPPETS)).cast("int") + 1)


# ---- identity, exact dedup, unions


@query("SELECT doc_id, substr(sha256(text), 1, 16) AS hash, 'vex_' || substr(sha256(text), 1, 16) AS id FROM documents")
def hash16_identity(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", identity.hash16(F.col("text")).alias("hash"), identity.derived_id(F.lit(""), F.col("text")).alias("id"))


@query("SELECT doc_id, sha256(lang || chr(10) || text) AS checksum FROM documents")
def record_checksum(spark, sf):
    return read(spark, sf, "documents").select("doc_id", identity.checksum(F.col("lang"), F.array("text")).alias("checksum"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def exact_dedup_first_wins(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return dedup.first_wins(d, F.col("h"), [F.col("doc_id")]).select("doc_id", "source")


@query("SELECT 0 AS src_ord, doc_id AS row_ord, source AS origin FROM documents UNION ALL SELECT 1, conv_id * 1000 + turn, role FROM conversations")
def source_union_ordered(spark, sf):
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("row_ord"), F.col("source").alias("origin"))
    c = read(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_ord"), F.col("role").alias("origin"))
    return files.union_in_order(d, c)


@query(f"SELECT d.doc_id, d.source, coalesce(r.label, d.source) AS label FROM documents d LEFT JOIN (VALUES ('src1', 'first'), ('src2', 'second')) r(source, label) ON d.source = r.source")
def source_labels(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "source", T.label_of(F.col("source"), {"src1": "first", "src2": "second"}).alias("label"))


# ---- statistics

LABELLED = "documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id"


def labelled(spark, sf):
    one = read(spark, sf, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return read(spark, sf, "documents").join(one, "doc_id", "left")


@query("SELECT source AS value, count(*) AS n FROM documents GROUP BY source")
def corpus_stats_by_source(spark, sf):
    return stats.counts(read(spark, sf, "documents"), "source")


@query(f"SELECT coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS value, count(*) AS n FROM {LABELLED} GROUP BY 1")
def corpus_stats_by_quality(spark, sf):
    return stats.counts(labelled(spark, sf).withColumn("q", F.col("quality").cast("string")), "q")


@query(f"SELECT count(*) AS total, count(l.quality) AS has_quality, count(l.toxic) AS has_toxic FROM {LABELLED}")
def corpus_coverage(spark, sf):
    return stats.coverage(labelled(spark, sf), ["quality", "toxic"])


@query("SELECT count(*) AS total, CAST(count_if(contains(text, '|')) AS BIGINT) AS with_code, CAST(floor(sum(length(text)) / count(*)) AS BIGINT) AS avg_length FROM documents")
def corpus_totals(spark, sf):
    return stats.totals(read(spark, sf, "documents"), F.length("text"), F.contains("text", F.lit("|")).cast("int"))


@query("SELECT v.value, coalesce(e.n, 0) AS n FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('never')) v(value) LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) e ON v.value = e.event_type")
def stage_zero_fill(spark, sf):
    return stats.zero_filled(read(spark, sf, "events"), "event_type", ["click", "view", "purchase", "signup", "never"])


RESULTS = "(SELECT CASE WHEN event_id % 5 = 0 THEN 'error' ELSE 'success' END AS status, value AS confidence, CAST(event_id % 7 AS DOUBLE) AS seconds FROM events)"


@query(f"""SELECT count(*) AS total, CAST(count_if(status = 'success') AS BIGINT) AS success, CAST(count_if(status = 'error') AS BIGINT) AS error, round(avg(confidence) FILTER (status = 'success'), 3) AS avg_confidence,
    round(avg(seconds), 3) AS avg_seconds, round(60 / avg(seconds), 3) AS per_minute FROM {RESULTS}""")
def batch_stats(spark, sf):
    e = read(spark, sf, "events")
    return models.batch_stats(e.select(F.when(F.col("event_id") % 5 == 0, "error").otherwise("success").alias("status"), F.col("value").alias("confidence"), (F.col("event_id") % 7).cast("double").alias("seconds")))


@query("SELECT doc_id, CASE WHEN n >= 30 THEN site ELSE 'misc' END AS grp FROM (SELECT doc_id, source || lang AS site, count(*) OVER (PARTITION BY source, lang) AS n FROM documents)")
def topic_groups_having(spark, sf):
    return stats.pooled_groups(read(spark, sf, "documents").select("doc_id", F.concat("source", "lang").alias("site")), "site", 30).select("doc_id", "grp")


# ---- text functions


@query(f"SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, CAST(len({SHINGLES}) AS INTEGER) AS n_shingles FROM (SELECT doc_id, {WORDS.format('lower(text)')} AS w FROM documents)")
def shingle_counts(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", T.words(F.lower("text")).alias("w"))
    return d.select("doc_id", F.size("w").alias("n_words"), F.size(T.shingles(F.col("w"))).alias("n_shingles"))


@query(r"SELECT doc_id, CASE WHEN length(h) > 200 THEN substr(h, 1, 197) || '...' ELSE h END || '.' AS sentence FROM (SELECT doc_id, regexp_replace(string_split(text, '. ')[1], '\.+$', '') AS h FROM documents)")
def first_sentence(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.first_sentence(F.col("text")).alias("sentence"))


@query(r"SELECT doc_id, CASE WHEN len(l) > 3 THEN array_to_string(l[1:3], chr(10)) || chr(10) || '// ...' ELSE array_to_string(l, chr(10)) END AS code FROM (SELECT doc_id, string_split(regexp_replace(text, '\n+$', ''), chr(10)) AS l FROM documents)")
def truncate_code(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.truncate_lines(F.col("text"), 3).alias("code"))


@query("SELECT DISTINCT value, array_to_string(list_transform(string_split(replace(value, '_', ' '), ' '), lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), ' ') AS label FROM (SELECT event_type || '_of_' || event_type AS value FROM events)")
def label_prettify(spark, sf):
    v = read(spark, sf, "events").select(F.concat_ws("_of_", "event_type", "event_type").alias("value")).distinct()
    return v.select("value", T.pretty_label(F.col("value")).alias("label"))


@query(f"SELECT t AS term, count(*) AS df, CAST(sum(n) AS BIGINT) AS cf FROM (SELECT doc_id, t, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS t FROM documents) GROUP BY doc_id, t) GROUP BY t")
def doc_freq(spark, sf):
    posted = search.postings(read(spark, sf, "documents"), "doc_id", F.col("text"))
    return posted.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@query(f"SELECT doc_id AS id, CAST(len({TOKENS.format('text')}) AS BIGINT) AS dl FROM documents")
def doc_lengths(spark, sf):
    return search.document_lengths(read(spark, sf, "documents"), "doc_id", F.col("text"))


@query(f"SELECT CAST(sum(len(t)) AS BIGINT) AS tokens, count(*) AS docs, CAST(floor(sum(len(t)) / count(*)) AS BIGINT) AS avg_dl FROM (SELECT {TOKENS.format('text')} AS t FROM documents)")
def token_stats(spark, sf):
    d = search.document_lengths(read(spark, sf, "documents"), "doc_id", F.col("text"))
    return d.agg(F.sum("dl").alias("tokens"), F.count("*").alias("docs"), F.floor(F.sum("dl") / F.count("*")).alias("avg_dl"))


# ---- retrieval

BM25 = f"""q AS (SELECT query_id, t AS term, count(*) AS times FROM (SELECT query_id, unnest({TOKENS.format('query')}) AS t FROM asked) GROUP BY ALL),
d AS (SELECT doc_id AS id, {TOKENS.format('text')} AS t, CAST(len({TOKENS.format('text')}) AS DOUBLE) AS dl FROM documents),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avg_dl FROM d),
p AS (SELECT id, dl, term, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT id, dl, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, ln((n.n - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf FROM p, n GROUP BY term, n.n),
s AS (SELECT query_id, id, round(sum(CAST(idf AS DOUBLE) * tf * 2.5e0 / (tf + 1.5e0 * (0.25e0 + 0.75e0 * dl / avg_dl)) * times), 6) AS score FROM p JOIN f USING (term) JOIN q USING (term), n GROUP BY query_id, id),
r AS (SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM s)"""
QUESTIONS = [("Q1", "the and of with that"), ("Q2", "idiot clown trash"), ("Q3", "@mail the the token"), ("Q4", "elle une pour les")]
ASKED = "asked AS (SELECT * FROM (VALUES " + ", ".join(f"({_q(a)}, {_q(b)})" for a, b in QUESTIONS) + ") v(query_id, query))"


def questions(spark):
    return spark.createDataFrame(QUESTIONS, "query_id string, query string")


def _bm25(spark, sf, k=20):
    return search.bm25(read(spark, sf, "documents"), "doc_id", F.col("text"), questions(spark), "query_id", F.col("query"), k)


@query(f"WITH {ASKED}, {BM25} SELECT query_id, id, score, rank FROM r WHERE rank <= 20")
def bm25_topk(spark, sf):
    return _bm25(spark, sf)


@query(f"WITH asked AS (SELECT item_id AS query_id, text AS query FROM benchmark), {BM25} SELECT query_id, id, score, rank FROM r WHERE rank <= 5")
def bm25_multi_query(spark, sf):
    return search.bm25(read(spark, sf, "documents"), "doc_id", F.col("text"), read(spark, sf, "benchmark"), "item_id", F.col("text"), 5)


@query("""WITH s AS (SELECT doc_id, 2 * len(list_filter(['idiot', 'the', 'trash'], lambda t: contains(lower(text), t)))
    + 3 * CAST(len(list_filter(['idiot', 'the', 'trash'], lambda t: contains(lower(lang), t))) > 0 AS INTEGER) + 3 * CAST(len(list_filter(['idiot', 'the', 'trash'], lambda t: contains(lower(source), t))) > 0 AS INTEGER)
    + 4 * CAST(len(list_filter(['idiot', 'the', 'trash'], lambda t: contains(lower(lang || 'the'), t))) > 0 AS INTEGER) + 2 * CAST(len(list_filter(['idiot', 'the', 'trash'], lambda t: contains(lower(text), t))) > 0 AS INTEGER) AS score FROM documents)
SELECT doc_id, CAST(score AS INTEGER) AS score FROM s WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 50""")
def keyword_weighted_search(spark, sf):
    d = read(spark, sf, "documents")
    terms = F.array(*map(F.lit, ["idiot", "the", "trash"]))
    score = search.keyword_score(terms, F.col("text"), F.col("lang"), F.col("source"), F.array(F.concat("lang", F.lit("the"))), F.col("text"))
    return d.select("doc_id", score.cast("int").alias("score")).where("score > 0").orderBy(F.desc("score"), "doc_id").limit(50)


NORMED = "v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / CASE WHEN n = 0 THEN 1 ELSE n END) AS v FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS n FROM embeddings))"
DENSE = f"""{NORMED}, c AS (SELECT q.id AS query_id, v.id AS id, round(list_dot_product(q.v, v.v), 5) AS score FROM v q, v WHERE q.id % 50 = 0),
e AS (SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM c)"""


def _dense(spark, sf, k):
    v = read(spark, sf, "embeddings")
    return search.dense(v, "vec_id", "embedding", v.where("vec_id % 50 = 0"), "vec_id", "embedding", k, 5)


@query(f"WITH {DENSE} SELECT query_id, id, score, rank FROM e WHERE rank <= 20")
def dense_topk(spark, sf):
    return _dense(spark, sf, 20)


LEXICAL = f"asked AS (SELECT doc_id AS query_id, text AS query FROM documents WHERE doc_id % 50 = 0), {BM25}"


def _both(spark, sf, depth):
    d = read(spark, sf, "documents")
    asked = d.where("doc_id % 50 = 0").select("doc_id", F.col("text").alias("query"))
    return search.bm25(d, "doc_id", F.col("text"), asked, "doc_id", F.col("query"), depth), _dense(spark, sf, depth)


@query(f"""WITH {LEXICAL}, {DENSE}, u AS (SELECT query_id, id, rank FROM r WHERE rank <= 30 UNION ALL SELECT query_id, id, rank FROM e WHERE rank <= 30),
x AS (SELECT query_id, id, round(sum(1e0 / (60 + rank)), 8) AS score FROM u GROUP BY query_id, id),
y AS (SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM x) SELECT query_id, id, score, rank FROM y WHERE rank <= 10""")
def hybrid_search(spark, sf):
    return search.hybrid(*_both(spark, sf, 30), 10)


@query(f"""WITH {DENSE}, x AS (SELECT query_id, id, round(1e0 / (60 + rank), 8) AS score FROM e WHERE rank <= 20) SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM x""")
def rrf_single_list(spark, sf):
    return search.fuse([_dense(spark, sf, 20)], 20)


#: Judgments by which one question fails, one has its first hit late, and two pass.
PATTERNS = [("Q1", ["token", "@mail", "555-"]), ("Q2", ["idiot", "moron"]), ("Q3", ["@mail", "token", "idiot"]), ("Q4", ["elle", "pour", "eaux"])]
JUDGED = "pat AS (SELECT * FROM (VALUES " + ", ".join(f"({_q(a)}, [{', '.join(map(_q, b))}])" for a, b in PATTERNS) + ") v(query_id, patterns)), rel AS (SELECT query_id, doc_id AS id FROM pat, documents WHERE len(list_filter(patterns, lambda p: contains(lower(text), p))) >= 2)"


@query(f"""WITH {ASKED}, {BM25}, {JUDGED}, m AS (SELECT r.query_id, r.rank, CASE WHEN rel.id IS NULL THEN 0 ELSE 1 END AS rel FROM r LEFT JOIN rel ON r.query_id = rel.query_id AND r.id = rel.id WHERE r.rank <= 10),
a AS (SELECT query_id, count(*) AS returned, CAST(sum(rel) AS BIGINT) AS hits, avg(rel) FILTER (rank <= 5) AS p5, avg(rel) AS p, coalesce(1e0 / min(rank) FILTER (rel = 1), 0) AS mrr, sum(rel / log2(rank + 1)) AS dcg FROM m GROUP BY query_id),
b AS (SELECT a.*, coalesce(t.n, 0) AS relevant FROM a LEFT JOIN (SELECT query_id, count(*) AS n FROM rel GROUP BY query_id) t ON a.query_id = t.query_id)
SELECT query_id, returned, relevant, round(p5, 4) AS p_first, round(p, 4) AS p_all, round(CASE WHEN relevant > 0 THEN CAST(hits AS DOUBLE) / relevant ELSE 0 END, 4) AS recall, round(mrr, 4) AS mrr,
  round(CASE WHEN hits > 0 THEN dcg / list_sum(list_transform(range(1, hits + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 4) AS ndcg,
  round(CASE WHEN relevant > 0 THEN dcg / list_sum(list_transform(range(1, least(relevant, 10) + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 4) AS ndcg_full,
  CASE WHEN p5 >= 0.4 AND mrr > 0 THEN 'PASS' WHEN mrr > 0 THEN 'WEAK' ELSE 'FAIL' END AS verdict FROM b""")
def eval_metrics(spark, sf):
    patterns = spark.createDataFrame(PATTERNS, "query_id string, patterns array<string>")
    found = evaluate.judged(read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), F.col("text"), patterns)
    graph.shared_folder(spark)
    return evaluate.metrics(_bm25(spark, sf, 10), found.checkpoint())  # it is read twice


# ---- near duplicates

PAIRS = f"""WITH {SETS}, c AS (SELECT id, s, min(id) OVER (PARTITION BY list_sort(s)) AS cls FROM sets), u AS (SELECT id, s FROM c WHERE id = cls),
x AS (SELECT id, len(s) AS n, unnest(s) AS g FROM u), o AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS shared FROM x a JOIN x b ON a.g = b.g AND a.id < b.id GROUP BY ALL),
j AS (SELECT a, b, CAST(shared AS DOUBLE) / (na + nb - shared) AS similarity FROM o)"""
#: Links of all members: a class stands by its member of highest authority, and its other members are linked to that one.
LINKED = f"""{PAIRS}, w AS (SELECT c.id, c.cls, {AUTHORITY} AS w FROM c JOIN documents d ON d.doc_id = c.id),
best AS (SELECT cls, id AS best FROM (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY w DESC, id) AS r FROM w) WHERE r = 1),
l AS (SELECT least(x.best, y.best) AS a, greatest(x.best, y.best) AS b, similarity FROM j JOIN best x ON x.cls = j.a JOIN best y ON y.cls = j.b WHERE similarity >= 0.8
  UNION ALL SELECT least(id, best), greatest(id, best), 1.0 FROM w JOIN best USING (cls) WHERE id <> best)"""
ACTED = f"""{LINKED}, k AS (SELECT a, b, similarity, x.source AS source_a, y.source AS source_b, {AUTHORITY.replace('source', 'x.source')} AS authority_a, {AUTHORITY.replace('source', 'y.source')} AS authority_b
  FROM l JOIN documents x ON a = x.doc_id JOIN documents y ON b = y.doc_id),
z AS (SELECT *, CASE WHEN similarity > 0.95 THEN 'DROP' WHEN similarity > 0.9 THEN 'MERGE' ELSE 'LINK' END AS action, CASE WHEN authority_b > authority_a THEN b ELSE a END AS keep, CASE WHEN authority_b > authority_a THEN a ELSE b END AS other FROM k)"""


def _sets(spark, sf):
    return dedup.shingle_sets(read(spark, sf, "documents"), "doc_id", F.col("text"))


def _signatures(spark, sf):
    return dedup.signatures(read(spark, sf, "documents"), "doc_id", F.col("text"))


def _hashed(spark, sf):
    return dedup.hashed_sets(read(spark, sf, "documents"), "doc_id", F.col("text"))


def _linked(spark, sf):
    """Links of all documents, copies included, the documents with their authority, and their classes."""
    docs = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source", authority().alias("authority"))
    sets, members = dedup.prepared(_hashed(spark, sf))
    return dedup.with_copies(dedup.jaccard_pairs(sets, 0.8, members), members, docs).checkpoint(), docs, members


def _spanning(spark, sf):
    """Links that span every family and all copies, for questions of membership alone."""
    sets, members = dedup.prepared(_hashed(spark, sf))
    return dedup.family_links(sets, 0.8, members).select("a", "b").unionByName(dedup.copy_links(members)).checkpoint()


def _acted(spark, sf):
    return dedup.actions(dedup.with_sources(*_linked(spark, sf)[:2]))


@query(f"{PAIRS} SELECT a, b, round(similarity, 6) AS similarity FROM j WHERE similarity >= 0.8")
def jaccard_pairs(spark, sf):
    return dedup.jaccard_pairs(_hashed(spark, sf), 0.8).withColumn("similarity", F.round("similarity", 6))


@query(f"WITH {SETS}, c AS (SELECT id, min(id) OVER (PARTITION BY list_sort(s)) AS class FROM sets) SELECT id, class FROM c")
def copy_classes(spark, sf):
    return dedup.labels(_hashed(spark, sf))


@query(f"{ACTED} SELECT a, b, source_a, source_b, action, keep, other FROM z")
def dedup_actions(spark, sf):
    return _acted(spark, sf).select("a", "b", "source_a", "source_b", "action", "keep", "other")


@query(f"{ACTED} SELECT count(*) AS pairs, CAST(count_if(action = 'DROP') AS BIGINT) AS \"drop\", CAST(count_if(action = 'MERGE') AS BIGINT) AS \"merge\", CAST(count_if(action = 'LINK') AS BIGINT) AS link, CAST(count_if(source_a <> source_b) AS BIGINT) AS cross_source, CAST(count_if(source_a = source_b) AS BIGINT) AS same_source FROM z")
def dedup_stats(spark, sf):
    return dedup.dedup_stats(_acted(spark, sf))


@query(f"{ACTED} SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT other FROM z WHERE action = 'DROP')")
def apply_dedup(spark, sf):
    return dedup.apply_actions(read(spark, sf, "documents").select("doc_id", "source"), _acted(spark, sf), "doc_id")


CLUSTERED = f"""WITH RECURSIVE {LINKED.removeprefix('WITH ')}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t(node, comp) AS (SELECT a, a FROM e UNION SELECT e.b, t.comp FROM t JOIN e ON e.a = t.node), m AS (SELECT node, min(comp) AS cluster FROM t GROUP BY node)"""


@query(f"""{CLUSTERED} SELECT cluster, array_to_string(list_sort(list(node)), ',') AS members, count(*) AS size FROM m GROUP BY cluster""")
def dup_clusters(spark, sf):
    found = dedup.clusters(_spanning(spark, sf))
    return found.select("cluster", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"), "size")


@query(f"{CLUSTERED} SELECT node AS id, cluster FROM m")
def cluster_members(spark, sf):
    return dedup.membership(_spanning(spark, sf))


@query(f"""{PAIRS}, n AS (SELECT cls, count(*) AS n FROM c GROUP BY cls), e AS (SELECT a, b FROM j WHERE similarity >= 0.8 UNION ALL SELECT b, a FROM j WHERE similarity >= 0.8),
k AS (SELECT e.a AS cls, sum(n) AS links FROM e JOIN n ON n.cls = e.b GROUP BY e.a) SELECT c.id, c.cls AS class, CAST(coalesce(links, 0) AS BIGINT) AS links FROM c LEFT JOIN k USING (cls)""")
def link_counts(spark, sf):
    sets, members = dedup.prepared(_hashed(spark, sf))
    return dedup.link_counts(dedup.jaccard_pairs(sets, 0.8, members), members)


@query(f"{ACTED} SELECT a, b, action FROM z WHERE action IN ('DROP', 'MERGE')")
def dedup_actionable(spark, sf):
    return dedup.actionable(_acted(spark, sf)).select("a", "b", "action")


@query(f"""{CLUSTERED}, {ACTED[len(LINKED):].lstrip(', ')}
SELECT count(*) AS pairs, CAST(count_if(action = 'DROP') AS BIGINT) AS "drop", CAST(count_if(action = 'MERGE') AS BIGINT) AS "merge", CAST(count_if(action = 'LINK') AS BIGINT) AS link, CAST(count_if(source_a <> source_b) AS BIGINT) AS cross_source, CAST(count_if(source_a = source_b) AS BIGINT) AS same_source,
  (SELECT count(DISTINCT cluster) FROM m) AS clusters, (SELECT count(*) FROM sets) AS indexed, (SELECT count(*) FROM documents) - (SELECT count(*) FROM sets) AS skipped, CAST(0.8 AS DOUBLE) AS threshold FROM z""")
def dedup_report(spark, sf):
    links, docs, members = _linked(spark, sf)
    indexed = members.count()
    return dedup.report_stats(dedup.actions(dedup.with_sources(links, docs)), dedup.membership(links), indexed, docs.count() - indexed, 0.8)


MIN = ", ".join(f"min(({a} * (h % {dedup.PRIME}) + {b}) % {dedup.PRIME}) AS p{i}" for i, (a, b) in enumerate(dedup.permutations()))
SIGNATURE = "[" + ", ".join(f"p{i}" for i in range(128)) + "]"
SIGNED = f"h AS (SELECT id, CAST(('0x' || substr(md5(g), 1, 8)) AS BIGINT) AS h FROM (SELECT id, unnest(s) AS g FROM sets)), signed AS (SELECT id, {SIGNATURE} AS sig FROM (SELECT id, {MIN} FROM h GROUP BY id))"


@query(f"WITH {SETS}, {SIGNED} SELECT id, array_to_string(sig, ',') AS signature FROM signed")
def minhash_signature(spark, sf):
    return _signatures(spark, sf).select("id", F.array_join(F.transform("signature", lambda p: p.cast("string")), ",").alias("signature"))


def _representatives(spark, sf):
    """Classes of equal sets, and the signature of the first of each."""
    members = dedup.classes(_hashed(spark, sf))
    return members, _signatures(spark, sf).join(members.where("id = class").select("id"), "id", "left_semi").checkpoint()


def _candidates(spark, sf):
    """Classes of equal sets, and pairs of the first of each that share a band.

    All 128 permutations in bands of 4 give every pair that fewer bands of 4 give.
    """
    members, signed = _representatives(spark, sf)
    return members, dedup.lsh_candidates(signed, 32, 4)


def _banded(bands: int, rows: int) -> str:
    return f"""b AS (SELECT signed.id, k, sig[{rows} * k + 1 : {rows} * k + {rows}] AS v FROM signed JOIN c ON signed.id = c.id AND c.id = c.cls, range({bands}) r(k)),
cand AS (SELECT DISTINCT x.id AS a, y.id AS b FROM b x JOIN b y ON x.k = y.k AND x.v = y.v AND x.id < y.id)"""


COPIES = "SELECT cls AS a, id AS b FROM c WHERE id <> cls"


@query(f"{PAIRS}, {SIGNED}, {_banded(32, 4)} SELECT a, b FROM cand UNION ALL {COPIES}")
def lsh_candidates(spark, sf):
    members, found = _candidates(spark, sf)
    return found.unionByName(dedup.copy_links(members))


@query(f"{PAIRS}, {SIGNED}, {_banded(32, 4)} SELECT a, b, round(similarity, 6) AS similarity FROM j JOIN cand USING (a, b) WHERE similarity >= 0.8 UNION ALL SELECT a, b, 1.0 FROM ({COPIES})")
def minhash_pairs(spark, sf):
    members, found = _candidates(spark, sf)
    near = dedup.exact_pairs(members.where("id = class").select("id", "set"), found, 0.8).withColumn("similarity", F.round("similarity", 6))
    return near.unionByName(dedup.copy_links(members).withColumn("similarity", F.lit(1.0)))


@query(f"""{PAIRS}, {SIGNED}, {_banded(*dedup.bands_for(0.85))}, e AS (SELECT a, b, CAST(list_sum(list_transform(range(1, 129), lambda i: CAST(x.sig[i] = y.sig[i] AS INTEGER))) AS DOUBLE) / 128 AS estimate FROM cand JOIN signed x ON a = x.id JOIN signed y ON b = y.id)
SELECT a, b, estimate, round(similarity, 6) AS similarity FROM e JOIN j USING (a, b) WHERE similarity >= 0.85 UNION ALL SELECT a, b, 1.0, 1.0 FROM ({COPIES})""")
def minhash_estimates(spark, sf):
    """Pairs for a report at 0.85, by bands chosen for 0.95 of those at the threshold: the share of equal permutations, and the exact similarity, which decides."""
    members, signed = _representatives(spark, sf)
    found = dedup.lsh_candidates(signed, *dedup.bands_for(0.85)).checkpoint()
    exact = dedup.exact_pairs(members.where("id = class").select("id", "set"), found, 0.85)
    out = dedup.estimated_pairs(signed, found, 0.0).withColumnRenamed("similarity", "estimate").join(exact, ["a", "b"])
    return out.withColumn("similarity", F.round("similarity", 6)).unionByName(dedup.copy_links(members).withColumns({"estimate": F.lit(1.0), "similarity": F.lit(1.0)}))


@query(f"""WITH {SETS}, q AS (SELECT item_id, unnest({SHINGLES}) AS g FROM (SELECT item_id, {WORDS.format('lower(text)')} AS w FROM benchmark)), d AS (SELECT id, unnest(s) AS g FROM sets),
n AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id) SELECT id, item_id, round(CAST(count(*) AS DOUBLE) / n, 6) AS share FROM d JOIN q USING (g) JOIN n USING (item_id) GROUP BY id, item_id, n HAVING CAST(count(*) AS DOUBLE) / n >= 0.5""")
def benchmark_contamination(spark, sf):
    items = dedup.shingle_sets(read(spark, sf, "benchmark"), "item_id", F.col("text"), least_words=1)
    return dedup.contamination(_sets(spark, sf), items, 0.5).select("id", F.col("item").alias("item_id"), F.round("share", 6).alias("share"))


# ---- rules

TYPE = f"""CASE WHEN {_rany('t', P.REFERENCE_SIGNALS)} THEN 'reference' WHEN {_rcount('t', P.TROUBLE_SIGNALS)} >= 2 THEN 'troubleshooting'
  WHEN has_code AND {_rany('t', P.PATTERN_SIGNALS)} THEN 'pattern' WHEN {_rcount('t', P.DISCUSSION_SIGNALS)} >= 2 THEN 'discussion' WHEN {_rany('t', P.CONCEPT_SIGNALS)} THEN 'concept'
  WHEN has_code AND length(content) < 100 THEN 'pattern' ELSE 'concept' END"""
LINES = rf"length({STRIP.format('code')}) - length(replace({STRIP.format('code')}, chr(10), '')) + 1"
LEVEL = f"""CASE WHEN {_any('t', P.EXPERT_SIGNALS)} THEN 'expert' WHEN {_count('t', P.ADVANCED_SIGNALS)} >= 2 THEN 'advanced'
  WHEN {_count('t', P.INTERMEDIATE_SIGNALS)} >= 2 OR {_count('t', P.ADVANCED_SIGNALS)} >= 1 THEN 'intermediate' WHEN {LINES} > 20 THEN 'advanced' WHEN {LINES} > 8 THEN 'intermediate' ELSE 'beginner' END"""
FOUND = "list_concat(" * (len(P.CONTEXT_SIGNALS) - 1) + ", ".join((f"CASE WHEN {_any('code', s)} THEN ['{c}'] ELSE CAST([] AS VARCHAR[]) END" + (")" if k else "")) for k, (c, s) in enumerate(P.CONTEXT_SIGNALS.items()))
CONTEXTS = f"CASE WHEN len(f) = 0 THEN NULL WHEN len(f) = 1 AND {_any('code', P.SOP_SIGNALS)} THEN array_to_string(list_sort(list_append(f, 'sop')), ',') ELSE array_to_string(list_sort(f), ',') END"


CODED = f"(SELECT doc_id, source, {PLANTED} || ' ' || text AS content, {PLANTED} AS code FROM documents)"


def coded(spark, sf):
    """Documents with a planted snippet as code, and before their text."""
    return read(spark, sf, "documents").withColumn("code", planted()).withColumn("content", F.concat("code", F.lit(" "), "text"))


@query(f"SELECT doc_id, {TYPE} AS content_type FROM (SELECT doc_id, content, doc_id % 2 = 0 AS has_code, lower(content || ' ' || source) AS t FROM (SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN code ELSE content END AS content) FROM {CODED}))")
def classify_content_type(spark, sf):
    d = coded(spark, sf).withColumn("content", F.when(F.col("doc_id") % 5 == 0, F.col("code")).otherwise(F.col("content")))
    d = d.withColumn("t", C.typed_text(F.col("content"), F.col("source")))
    return d.select("doc_id", C.content_type(F.col("content"), F.col("source"), F.col("doc_id") % 2 == 0, F.lit(False), F.col("t")).alias("content_type"))


@query(f"SELECT doc_id, {LEVEL} AS difficulty FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN code ELSE content END AS code, lower((CASE WHEN doc_id % 2 = 0 THEN code ELSE content END) || ' ' || source) AS t FROM {CODED}) WHERE code <> ''")
def classify_difficulty(spark, sf):
    d = coded(spark, sf).withColumn("code", F.when(F.col("doc_id") % 2 == 0, F.col("code")).otherwise(F.col("content"))).where("code <> ''")
    d = d.withColumn("t", C.leveled_text(F.col("code"), F.col("source")))
    return d.select("doc_id", C.difficulty(F.col("code"), F.col("source"), F.col("t")).alias("difficulty"))


@query(f"SELECT doc_id, {CONTEXTS} AS contexts FROM (SELECT doc_id, code, {FOUND} AS f FROM {CODED})")
def detect_contexts(spark, sf):
    return coded(spark, sf).select("doc_id", F.array_join(C.contexts(F.col("code")), ",").alias("contexts"))


LOCAL_FOUND = "list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {_any('code', x)} THEN '{c}' END" for c, x in P.LOCAL_CONTEXTS) + "], lambda c: c IS NOT NULL)))"


@query(f"SELECT doc_id, CASE WHEN len(f) > 0 THEN array_to_string(f, ',') ELSE 'sop' END AS contexts FROM (SELECT doc_id, {LOCAL_FOUND} AS f FROM {CODED})")
def local_contexts(spark, sf):
    return coded(spark, sf).select("doc_id", F.array_join(C.local_contexts(F.col("code")), ",").alias("contexts"))


VERSIONS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(code, {_q(p)}) THEN {_q(v)} END" for p, v, _ in P.VERSION_RULES) + "], lambda x: x IS NOT NULL)"
NOTES = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(code, {_q(p)}) THEN {_q(n)} END" for p, _, n in P.VERSION_RULES) + "], lambda x: x IS NOT NULL), '; ')"


@query(f"SELECT doc_id, coalesce(list_max({VERSIONS}), '') AS version, {NOTES} AS notes FROM {CODED}")
def version_detect(spark, sf):
    v, notes = C.version(F.col("code"))
    return coded(spark, sf).select("doc_id", v.alias("version"), notes.alias("notes"))


BEST = "list_max([" + ", ".join(f"{{'n': {_count('code', s)}, 'o': {-k}, 'c': '{c}'}}" for k, (c, s) in enumerate(P.TOPIC_SIGNALS.items())) + "])"


TOPIC = f"CASE WHEN length(code) < 10 THEN '' WHEN b.n > 0 THEN b.c ELSE 'math_operations' END"


@query(f"SELECT doc_id, {TOPIC} AS topic FROM (SELECT doc_id, code, {BEST} AS b FROM {CODED})")
def topic_argmax(spark, sf):
    return coded(spark, sf).select("doc_id", C.topic(F.col("code")).alias("topic"))


NAMES = ["Point Cloud Operations", "flow visualization, x", " Some New Topic ", "edge topology, edge operations", "single", "Mixed Case, rest", "array operations"]
KNOWN = "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in P.TOPIC_NAMES.items()) + "}"


@query(f"""SELECT name, coalesce({KNOWN}[lower(trim(name))], {KNOWN}[lower(f)], CASE WHEN contains(f, ' ') THEN replace(lower(f), ' ', '_') ELSE f END) AS topic, n
FROM (SELECT name, trim(CASE WHEN contains(name, ',') THEN string_split(name, ',')[1] ELSE name END) AS f, count(*) AS n FROM (SELECT [{', '.join(map(_q, NAMES))}][CAST(conv_id % {len(NAMES)} AS INTEGER) + 1] AS name FROM conversations) GROUP BY name)""")
def topic_normalize(spark, sf):
    name = F.element_at(F.array(*map(F.lit, NAMES)), (F.col("conv_id") % len(NAMES)).cast("int") + 1)
    c = read(spark, sf, "conversations").select(name.alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return c.select("name", C.normal_topic(F.col("name")).alias("topic"), "n")


TAGGED = f"""(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'discussion' WHEN doc_id % 3 = 1 THEN 'concept' ELSE '' END AS ct, CASE WHEN doc_id % 4 = 0 THEN 'expert' WHEN doc_id % 4 = 1 THEN '' ELSE 'beginner' END AS df,
  CASE WHEN doc_id % 5 = 0 THEN 'cvex' WHEN doc_id % 5 = 1 THEN '' ELSE 'sop' END AS ctx, CASE WHEN doc_id % 2 = 0 THEN '' ELSE '18.0' END AS ver, source, content, code, code <> '' AS has_code, lower(content || ' ' || source) AS t, {FOUND} AS f FROM {CODED})"""


@query(f"""WITH w AS (SELECT *, {TYPE} AS new_ct FROM {TAGGED}), x AS (SELECT *, {LEVEL} AS new_df, {CONTEXTS} AS new_ctx, coalesce(list_max({VERSIONS}), '') AS new_ver FROM (SELECT * REPLACE (lower(code || ' ' || content || ' ' || source) AS t) FROM w)),
y AS (SELECT *, ct IN ('', 'concept') AND new_ct <> ct AS c1, df IN ('', 'beginner') AND new_df <> df AS c2, ctx IN ('', 'sop') AND new_ctx IS NOT NULL AND new_ctx <> ctx AS c3, ver = '' AND new_ver <> '' AS c4 FROM x)
SELECT doc_id, CASE WHEN c1 THEN new_ct ELSE ct END AS content_type, CASE WHEN c2 THEN new_df ELSE df END AS difficulty, CASE WHEN c3 THEN new_ctx ELSE ctx END AS contexts, CASE WHEN c4 THEN new_ver ELSE ver END AS version,
  array_to_string(list_filter([CASE WHEN c1 THEN 'content_type: ' || CASE WHEN ct = '' THEN 'empty' ELSE ct END || ' -> ' || new_ct END, CASE WHEN c2 THEN 'difficulty: ' || CASE WHEN df = '' THEN 'empty' ELSE df END || ' -> ' || new_df END,
  CASE WHEN c3 THEN 'vex_context: [' || CASE WHEN ctx = '' THEN '' ELSE chr(39) || ctx || chr(39) END || '] -> [' || chr(39) || replace(new_ctx, ',', chr(39) || ', ' || chr(39)) || chr(39) || ']' END, CASE WHEN c4 THEN 'houdini_version_min: ' || new_ver END], lambda d: d IS NOT NULL), '; ') AS decisions FROM y""")
def tag_merge_decisions(spark, sf):
    tagged = _tagged(spark, sf)
    return tagged.select("doc_id", "content_type", "difficulty", F.array_join("vex_context", ",").alias("contexts"), F.col("houdini_version_min").alias("version"), F.array_join("decisions", "; ").alias("decisions"))


def _tagged(spark, sf):
    n = lambda k: F.col("doc_id") % k
    none = F.array().cast("array<string>")
    d = coded(spark, sf).select(
        "doc_id", F.when(n(3) == 0, "discussion").when(n(3) == 1, "concept").otherwise("").alias("content_type"), F.when(n(4) == 0, "expert").when(n(4) == 1, "").otherwise("beginner").alias("difficulty"),
        F.when(n(5) == 0, F.array(F.lit("cvex"))).when(n(5) == 1, none).otherwise(F.array(F.lit("sop"))).alias("vex_context"), F.when(n(2) == 0, "").otherwise("18.0").alias("houdini_version_min"), F.lit("").alias("houdini_version_notes"),
        "content", F.col("source").alias("title"), "code",
    )
    return records.tag(d, F.col("code"), F.lit(False))


BUGGY = f"(SELECT doc_id, code, CASE WHEN doc_id % 2 = 0 THEN ['resource_leak', 'style'] ELSE ['pcopen misuse'] END AS bugs, CASE doc_id % 3 WHEN 0 THEN 'point_cloud_ops' WHEN 1 THEN '' ELSE lang END AS topic, {BEST} AS b FROM {CODED} JOIN documents USING (doc_id, source))"


@query(f"""SELECT doc_id, array_to_string(CASE WHEN {_any('code', P.POINT_CLOUD_CALLS)} THEN bugs ELSE list_filter(bugs, lambda b: NOT (contains(b, 'pcopen') OR contains(b, 'pcclose') OR contains(b, 'resource_leak'))) END, ',') AS bugs,
CASE WHEN NOT {_any('code', P.POINT_CLOUD_CALLS)} AND len(bugs) = 1 THEN 'clean' ELSE 'minor_issues' END AS quality,
CASE WHEN topic = 'point_cloud_ops' AND NOT {_any('code', P.POINT_CLOUD_TOPIC)} THEN coalesce(nullif({TOPIC}, ''), topic) ELSE topic END AS topic FROM {BUGGY}""")
def repair_corpus(spark, sf):
    kinds = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("resource_leak"), F.lit("style"))).otherwise(F.array(F.lit("pcopen misuse")))
    topic = F.when(F.col("doc_id") % 3 == 0, "point_cloud_ops").when(F.col("doc_id") % 3 == 1, "").otherwise(F.col("lang"))
    d = coded(spark, sf).select("doc_id", "code", "content", topic.alias("llm_topic"), F.lit("minor_issues").alias("llm_code_quality"), F.transform(kinds, lambda k: F.struct(k.alias("type"), F.lit("").alias("description"))).alias("llm_bugs"))
    r = records.repair(d, F.col("code"))
    return r.select("doc_id", F.array_join(F.transform("llm_bugs", lambda b: b["type"]), ",").alias("bugs"), F.col("llm_code_quality").alias("quality"), F.col("llm_topic").alias("topic"))


_LIST = lambda xs: "[" + ", ".join(map(_q, xs)) + "]"
#: Brackets are doubled, as a match takes the bracket before a name with it.
CALLS = rf"""list_sort(list_distinct(list_filter(list_transform(list_filter(regexp_extract_all(replace(code, '(', '(('), '(?:^|[^.@#\w])([a-zA-Z_]\w*)\s*\(', 1), lambda f: NOT list_contains({_LIST(P.NOT_CALLS)}, lower(f))),
  lambda f: CASE WHEN list_contains({_LIST(P.CASTS)}, lower(f)) THEN lower(f) ELSE f END), lambda f: regexp_matches(f, '^[a-z]') OR list_contains({_LIST(sorted(set(P.KNOWN_CALLS)))}, lower(f)))))"""


@query(f"SELECT doc_id, array_to_string({CALLS}, ',') AS calls FROM {CODED}")
def extract_calls(spark, sf):
    return coded(spark, sf).select("doc_id", F.array_join(C.calls(F.col("code")), ",").alias("calls"))


@query(r"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '@(\w+)', 1), lambda a: NOT list_contains(regexp_extract_all(text, '@(\w+)\s*=', 1), a)))), ',') AS read, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '@(\w+)\s*=', 1))), ',') AS written
FROM (SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN ' @Cd = @P;' ELSE ' @N += 1' END AS text FROM documents)""")
def attr_read_write(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", F.concat("text", F.when(F.col("doc_id") % 2 == 0, " @Cd = @P;").otherwise(" @N += 1")).alias("c"))
    a = C.attributes(F.col("c"))
    return d.select("doc_id", F.array_join(a["read"], ",").alias("read"), F.array_join(a["written"], ",").alias("written"))


BAL = "(length(code) - length(replace(code, '{0}', '')) - (length(code) - length(replace(code, '{1}', ''))))"


def _balance(a: str, b: str, name: str) -> str:
    n = BAL.format(a, b)
    return f"CASE WHEN {n} > 0 THEN 'Unclosed {name}: ' || {n} || ' more {a} than {b}' WHEN {n} < 0 THEN 'Extra closing {name}: ' || -{n} || ' more {b} than {a}' END"


WARNINGS = rf"""list_filter(list_concat(list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN NOT (lines[i] = '' OR regexp_matches(lines[i], '[;{{}},(\\:]$') OR regexp_matches(lines[i], '^(?://|#|/\*|\*)') OR ends_with(lines[i], '*/') OR NOT contains(lines[i], '='))
  THEN 'Line ' || i || ': possible missing semicolon: ' || substr(lines[i], 1, 60) END), [{_balance('{', '}', 'braces')}, {_balance('(', ')', 'parentheses')}, {", ".join(f"CASE WHEN regexp_matches(code, {_q(p)}) THEN {_q(m)} END" for p, m in P.DEPRECATED)},
  CASE WHEN contains(code, 'pcopen') AND NOT contains(code, 'pcclose') THEN 'pcopen() called without pcclose() -- potential resource leak' END, {", ".join(rf"CASE WHEN regexp_matches(code, '@{a}\s*=') THEN 'Assigning to @{a} -- this is a read-only attribute' END" for a in P.READ_ONLY)}]), lambda x: x IS NOT NULL)"""
WARNED = rf"(SELECT *, {WARNINGS} AS warnings FROM (SELECT *, list_transform(string_split({STRIP.format('code')}, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')) AS lines FROM {CODED}))"


@query(f"SELECT doc_id, array_to_string(warnings, '|') AS warnings FROM {WARNED}")
def validate_code(spark, sf):
    return coded(spark, sf).select("doc_id", F.array_join(C.warnings(F.col("code")), "|").alias("warnings"))


@query(f"SELECT doc_id, CAST({BAL.format('{', '}')} AS INTEGER) AS braces, CAST({BAL.format('(', ')')} AS INTEGER) AS parens FROM {CODED} WHERE {BAL.format('{', '}')} <> 0 OR {BAL.format('(', ')')} <> 0")
def validate_balance(spark, sf):
    warned = coded(spark, sf).select("doc_id", "code", C.warnings(F.col("code")).alias("w")).where(F.exists("w", lambda x: x.rlike("braces|parentheses")))
    return warned.select("doc_id", C.balance(F.col("code"), "{", "}").alias("braces"), C.balance(F.col("code"), "(", ")").alias("parens"))


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(list_concat(['zz', 'abs'], CASE WHEN doc_id % 2 = 0 THEN ['noise'] ELSE CAST([] AS VARCHAR[]) END), {CALLS}))), ',') AS calls, array_to_string(list_concat(['Unclosed braces: 1 more {{ than }}'], list_filter(warnings, lambda w: w <> 'Unclosed braces: 1 more {{ than }}')), '|') AS warnings FROM {WARNED}")
def enrich_chunks(spark, sf):
    return _extracted(spark, sf).select("doc_id", F.array_join("functions_referenced", ",").alias("calls"), F.array_join("validation_warnings", "|").alias("warnings"))


def _unextracted(spark, sf):
    old = F.concat(F.array(F.lit("zz"), F.lit("abs")), F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("noise"))).otherwise(F.array().cast("array<string>")))
    return coded(spark, sf).select("doc_id", "code", old.alias("functions_referenced"), F.array(F.lit("Unclosed braces: 1 more { than }")).alias("validation_warnings"))


def _extracted(spark, sf):
    return records.extract(_unextracted(spark, sf), F.col("code"))


@query(rf"""SELECT doc_id, CASE WHEN l <= 2 AND doc_id % 9 <= 2 THEN 'simple' WHEN l <= 8 AND doc_id % 9 <= 5 THEN 'moderate' ELSE 'complex' END AS complexity FROM (SELECT doc_id, {LINES} AS l FROM (SELECT doc_id, text AS code FROM documents))""")
def size_complexity(spark, sf):
    return read(spark, sf, "documents").select("doc_id", C.size_complexity(F.col("text"), F.col("doc_id") % 9).alias("complexity"))


@query(f"SELECT doc_id, {_any('text', P.SNIPPET_MARKS)} AS snippet FROM documents")
def snippet_predicate(spark, sf):
    return read(spark, sf, "documents").select("doc_id", C.looks_like_snippet(F.col("text")).alias("snippet"))


@query(f"SELECT doc_id, CASE WHEN {_any('t', P.LOCAL_ADVANCED)} THEN 'advanced' WHEN {_any('t', P.LOCAL_INTERMEDIATE)} THEN 'intermediate' ELSE 'beginner' END AS difficulty FROM (SELECT doc_id, lower(source || ' ' || code) AS t FROM {CODED})")
def local_difficulty(spark, sf):
    return coded(spark, sf).select("doc_id", C.local_difficulty(F.col("source"), F.col("code")).alias("difficulty"))


@query("SELECT n, CASE WHEN n <= 2 THEN 'beginner' WHEN n <= 4 THEN 'intermediate' WHEN n <= 7 THEN 'advanced' ELSE 'expert' END AS difficulty, c FROM (SELECT event_id % 10 + 1 AS n, count(*) AS c FROM events GROUP BY 1)")
def difficulty_labels(spark, sf):
    e = read(spark, sf, "events").groupBy((F.col("event_id") % 10 + 1).alias("n")).agg(F.count("*").alias("c"))
    return e.select("n", C.difficulty_of_number(F.col("n")).alias("difficulty"), "c")


# ---- graph

INTROS = f"""i AS (SELECT concept, id, CAST(row_number() OVER (PARTITION BY concept ORDER BY authority DESC, ord) AS INTEGER) AS place FROM (
  SELECT doc_id AS ord, 'd' || doc_id AS id, {AUTHORITY} AS authority, unnest(list_filter([{', '.join(f"CASE WHEN regexp_matches(x, {_q('(?i)' + p)}) THEN '{c}' END" for c, p in P.CONCEPT_INTROS.items())}], lambda c: c IS NOT NULL)) AS concept
  FROM (SELECT *, text || CASE WHEN doc_id % 50 = 1 THEN ' noise random' WHEN doc_id % 70 = 2 THEN ' matrix rotate' ELSE '' END AS x FROM documents)))"""


def _intros(spark, sf, top):
    d = read(spark, sf, "documents")
    x = F.concat("text", F.when(F.col("doc_id") % 50 == 1, " noise random").when(F.col("doc_id") % 70 == 2, " matrix rotate").otherwise(""))
    chunks = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("doc_id").alias("ord"), authority().alias("authority"), x.alias("x"))
    return graph.concept_intros(chunks, F.col("x"), top)


@query(f"WITH {INTROS} SELECT concept, id, place FROM i WHERE place <= 5")
def concept_intro_top5(spark, sf):
    return _intros(spark, sf, 5)


EDGES = f"""{INTROS}, ep AS (SELECT conv_id AS episode, 'c' || conv_id || '_' || min(turn) AS id FROM conversations GROUP BY conv_id), k AS (SELECT 'd' || doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN 'noise' ELSE 'matrices' END AS concept FROM documents WHERE doc_id % 5 <= 1),
g AS (SELECT a.id AS src, b.id AS dst, 'episode' AS rule FROM ep a JOIN ep b ON a.episode = b.episode + 1 WHERE a.episode > 1
  UNION SELECT k.id, i.id, 'concept' FROM k JOIN i ON k.concept = i.concept AND i.place <= 2 WHERE k.id <> i.id UNION SELECT 'd' || d.doc_id, ep.id, 'mention' FROM documents d JOIN ep ON ep.episode = d.doc_id % 400 WHERE d.doc_id % 11 = 0)"""


def _edges(spark, sf):
    d = read(spark, sf, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    chunks = d.select(name.alias("id"), F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("curlnoise"), F.lit("noise"))).when(F.col("doc_id") % 5 == 1, F.array(F.lit("invert"))).otherwise(F.array(F.lit("other"))).alias("calls"))
    told = d.select(name.alias("id"), F.concat("text", F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit(" as shown in Joy of  VEX"), (F.col("doc_id") % 400).cast("string"), F.lit("."))).otherwise("")).alias("text"))
    return graph.prerequisite_edges(chunks, _intros(spark, sf, 2), _episodes(spark, sf), graph.mentions(told, F.col("text")))


def _episodes(spark, sf):
    turns = read(spark, sf, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"), F.col("conv_id").alias("episode"), F.col("turn").alias("ord"))
    return graph.first_of_episodes(turns)


@query(f"WITH {EDGES} SELECT src, dst, rule FROM g")
def prereq_edges(spark, sf):
    return _edges(spark, sf)


@query(f"WITH {EDGES} SELECT count(DISTINCT src) AS chunks_with_prereqs, count(*) AS total_links, (SELECT count(DISTINCT concept) FROM i) AS concepts, (SELECT count(*) FROM ep) AS episodes FROM (SELECT DISTINCT src, dst FROM g)")
def prereq_stats(spark, sf):
    return graph.graph_stats(_edges(spark, sf), _intros(spark, sf, 5), _episodes(spark, sf))


# ---- sources over pages and JSON


@query(r"SELECT page_id, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS title FROM pages")
def page_titles(spark, sf):
    return read(spark, sf, "pages").select("page_id", html.first_heading(F.col("html")).alias("title"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \t\n\r\f]+', ' ', 'g')) AS text FROM pages""")
def html_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query()
def html_chunks(spark, sf):
    c = html.page_chunks(read(spark, sf, "pages"))
    return c.select("page_id", "seq", "heading", "content", F.array_join("codes", "\n").alias("code"))


@query()
def html_links(spark, sf):
    return html.page_links(read(spark, sf, "pages"))


@query(r"SELECT page_id, CASE WHEN n <= 5 THEN 'beginner' WHEN n <= 13 THEN 'intermediate' ELSE 'advanced' END AS difficulty FROM (SELECT page_id, CAST(regexp_extract(url, '(\d{1,2})\D*$', 1) AS INTEGER) AS n FROM pages WHERE regexp_matches(url, '\d{1,2}\D*$'))")
def page_difficulty(spark, sf):
    p = read(spark, sf, "pages").select("page_id", html.page_number(F.col("url")).alias("n")).where("n is not null")
    return p.select("page_id", T.number_difficulty(F.col("n")).alias("difficulty"))


@query("SELECT k AS k, count(*) AS n FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY k")
def json_fields(spark, sf):
    e = files.json_values(read(spark, sf, "events"), "props", {"k": "bigint"})
    return e.groupBy("k").agg(F.count("*").alias("n"))


@query("""SELECT event_id, 'code' AS "key", 'int ' || event_type AS "value", 'e' || event_id AS id FROM events UNION ALL SELECT event_id, 'snippet', '@P' || event_id, '' FROM events WHERE event_id % 2 = 0""")
def json_walk(spark, sf):
    e = read(spark, sf, "events")
    inner = F.array(F.struct(F.concat(F.when(F.col("event_id") % 2 == 0, "@P").otherwise("no code "), F.col("event_id").cast("string")).alias("snippet")))
    tree = F.to_json(F.struct(F.concat(F.lit("int "), "event_type").alias("code"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), F.struct(F.struct(inner.alias("list")).alias("deep")).alias("a")))
    found = files.json_strings(e.select("event_id", tree.alias("tree")), "tree")
    return found.where(C.looks_like_snippet(F.col("value"))).select("event_id", "key", "value", "id")


# ---- export

TURNS = "conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'"


def _turns(spark, sf):
    c = read(spark, sf, "conversations")
    after = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("completion"))
    return c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt")).join(after, ["conv_id", "turn"])


@query(f"SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS completion FROM {TURNS} AND a.text <> ''")
def training_pairs(spark, sf):
    t = _turns(spark, sf).select("*", F.col("completion").alias("code"), F.lit(False).alias("flagged_for_review"), F.lit("").alias("context"), F.lit("").alias("difficulty"), F.struct("conv_id", "turn").alias("topic"))
    return export.training_pairs(t).select("metadata.topic.conv_id", "metadata.topic.turn", "prompt", "completion")


@query(f"""SELECT a.text || chr(10) || b.text AS chat FROM {TURNS}""")
def chat_export(spark, sf):
    return export.chats(_turns(spark, sf)).select(F.array_join(F.transform("messages", lambda m: m["content"]), "\n").alias("chat"))


@query("SELECT doc_id, lang, source, n_chars, substr(text, 1, 200) AS preview FROM documents")
def metadata_preview(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", T.preview(F.col("text")).alias("preview"))


@query(f"SELECT source, array_to_string(list_sort(list(k)), ',') AS keywords FROM (SELECT source, k, row_number() OVER (PARTITION BY source ORDER BY k) AS r FROM (SELECT DISTINCT source, trim(lower(unnest({TOKENS.format('text')}))) AS k FROM documents)) WHERE r <= 50 GROUP BY source")
def keywords_top50(spark, sf):
    k = stats.keywords(read(spark, sf, "documents").select("source", T.search_tokens(F.col("text")).alias("t")), "source", [F.col("t")])
    return k.select("source", F.array_join("keywords", ",").alias("keywords"))


@query(r"""WITH c AS (SELECT lang AS topic, doc_id, CASE doc_id % 3 WHEN 0 THEN 'beginner' WHEN 1 THEN 'expert' ELSE 'unknown' END AS level, source, text FROM documents),
e AS (SELECT topic, level, source, doc_id, '### T' || doc_id || chr(10) || chr(10) || (CASE WHEN length(h) > 200 THEN substr(h, 1, 197) || '...' ELSE h END) || '.' || chr(10) || chr(10) AS e FROM (SELECT *, regexp_replace(string_split(text, '. ')[1], '\.+$', '') AS h FROM c)),
s AS (SELECT topic, level, '## ' || (CASE level WHEN 'unknown' THEN 'Uncategorized' WHEN 'expert' THEN 'Expert' ELSE 'Beginner' END) || ' (' || count(*) || ' examples)' || chr(10) || chr(10) || string_agg(e, '' ORDER BY source, 'd' || doc_id) AS t FROM e GROUP BY topic, level),
b AS (SELECT topic, string_agg(t, '' ORDER BY CASE level WHEN 'beginner' THEN 0 WHEN 'expert' THEN 3 ELSE 4 END) AS body FROM s GROUP BY topic)
SELECT topic, '# Corpus: ' || upper(substr(topic, 1, 1)) || substr(topic, 2) || chr(10) || chr(10) || '> ' || n || ' examples from corpus. Sources: ' || srcs || chr(10) || chr(10) || body AS page
FROM b JOIN (SELECT topic, count(*) AS n, array_to_string(list_sort(list(DISTINCT source)), ', ') AS srcs FROM c GROUP BY topic) USING (topic)""")
def render_topic_page(spark, sf):
    d = read(spark, sf, "documents")
    level = F.when(F.col("doc_id") % 3 == 0, "beginner").when(F.col("doc_id") % 3 == 1, "expert")
    ident = F.col("doc_id").cast("string")
    return export.topic_pages(d.select(F.col("lang").alias("topic"), F.concat(F.lit("d"), ident).alias("id"), F.concat(F.lit("T"), ident).alias("title"), level.alias("difficulty"), F.col("source").alias("source_id"), F.lit("").alias("code"), F.col("text").alias("content")))


@query(f"""WITH k AS (SELECT lang, array_to_string(list_sort(list(k)), ',') AS keywords FROM (SELECT lang, k, row_number() OVER (PARTITION BY lang ORDER BY k) AS r FROM (SELECT DISTINCT lang, trim(lower(unnest({TOKENS.format('text')}))) AS k FROM documents)) WHERE r <= 50 GROUP BY lang),
l AS (SELECT lang, upper(lang[1]) || lang[2:] AS label, count(*) AS n, list_sort(list(DISTINCT source)) AS sources FROM documents GROUP BY lang)
SELECT 'corpus_' || lang AS file_key, 'Corpus: ' || label || ' (' || n || ' examples)' AS summary, 'Labeled examples for ' || lower(label) || '. Sources: ' || array_to_string(sources, ', ') || '. Covers ' || n || ' code snippets with difficulty ratings and metadata.' AS description, keywords FROM l JOIN k USING (lang)""")
def semantic_entries(spark, sf):
    d = read(spark, sf, "documents").select(F.col("lang").alias("topic"), F.col("source").alias("source_id"), T.search_tokens(F.col("text")).alias("t"))
    return export.semantic_entries(d, stats.keywords(d, "topic", [F.col("t")])).withColumn("keywords", F.array_join("keywords", ","))


@query("SELECT source AS file_key, count(*) AS n FROM documents WHERE NOT starts_with(source, 'src1') GROUP BY source UNION ALL SELECT 'src1_' || lang, count(*) FROM documents GROUP BY lang")
def index_merge(spark, sf):
    d = read(spark, sf, "documents")
    old = d.groupBy(F.col("source").alias("file_key")).agg(F.count("*").alias("n"))
    new = d.groupBy(F.concat(F.lit("src1_"), F.col("lang")).alias("file_key")).agg(F.count("*").alias("n"))
    return export.merge_namespace(old, new, "file_key", "src1")


@query("SELECT DISTINCT source || '_' || lang AS file FROM documents WHERE source || '_' || lang NOT IN (SELECT source || '_' || lang FROM documents WHERE doc_id % 7 = 0)")
def stale_files(spark, sf):
    d = read(spark, sf, "documents").withColumn("file", F.concat_ws("_", "source", "lang"))
    return export.stale(d.select("file").distinct(), d.where("doc_id % 7 = 0").select("file").distinct(), "file")


# ---- model-backed steps over simulated votes

VOTES = "(SELECT CAST(user_id AS VARCHAR) AS task_id, event_id AS ord, CASE WHEN event_type = 'error' OR event_id % 17 = 0 THEN NULL ELSE event_type END AS vote FROM events)"
CONSENSUS = f"""a AS (SELECT task_id, count(*) AS asked FROM {VOTES} GROUP BY task_id), c AS (SELECT task_id, vote, count(*) AS votes, min(ord) AS seen FROM {VOTES} WHERE vote IS NOT NULL GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY votes DESC, seen) AS r FROM c)"""


def _consensus(spark, sf):
    vote = F.when((F.col("event_type") != "error") & (F.col("event_id") % 17 != 0), F.col("event_type"))
    return models.consensus(read(spark, sf, "events").select(F.col("user_id").cast("string").alias("task_id"), F.col("event_id").alias("ord"), vote.alias("vote")))


@query(f"WITH {CONSENSUS} SELECT task_id, vote AS winner, votes, asked, round(CAST(votes AS DOUBLE) / asked, 6) AS consensus FROM w JOIN a USING (task_id) WHERE r = 1")
def consensus_vote(spark, sf):
    return _consensus(spark, sf).withColumn("consensus", F.round("consensus", 6))


GATED = "(SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 37 END AS confidence, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 10 AS DOUBLE) / 10 END AS consensus, ['success', 'success', 'success', 'error', 'success', 'uncertain', 'success'][CAST(event_id % 7 AS INTEGER) + 1] AS status FROM events)"


@query(f"""SELECT event_id, coalesce(confidence, 0) < 0.6 OR coalesce(consensus, 1) < 0.66 OR status IN ('error', 'uncertain') AS flagged,
  CASE WHEN coalesce(confidence, 0) < 0.6 THEN printf('Low confidence: %.2f', coalesce(confidence, 0)) ELSE '' END AS reason FROM {GATED}""")
def review_gate(spark, sf):
    g = _gated(spark, sf)
    return g.select("event_id", models.needs_review(F.col("confidence"), F.col("consensus"), F.col("status")).alias("flagged"), models.review_reason(F.col("confidence")).alias("reason"))


def _gated(spark, sf):
    n = F.col("event_id")
    status = F.when(n % 7 == 3, "error").when(n % 7 == 5, "uncertain").otherwise("success")
    return read(spark, sf, "events").select("event_id", F.when(n % 11 != 0, F.col("value") / 37).alias("confidence"), F.when(n % 3 != 0, (n % 10).cast("double") / 10).alias("consensus"), status.alias("status"))


@query(f"""SELECT CAST(count_if(NOT f) AS BIGINT) AS passed, CAST(count_if(f) AS BIGINT) AS flagged FROM (SELECT coalesce(confidence, 0) < 0.6 OR coalesce(consensus, 1) < 0.66 OR status IN ('error', 'uncertain') AS f FROM {GATED})""")
def review_split(spark, sf):
    g = _gated(spark, sf)
    passed, flagged = models.split_by_review(g, models.needs_review(F.col("confidence"), F.col("consensus"), F.col("status")))
    return passed.agg(F.count("*").alias("passed")).crossJoin(flagged.agg(F.count("*").alias("flagged")))


@query(f"SELECT d.doc_id, length(text) >= 10 AND l.quality IS NULL AS tier_one, length(text) >= 10 AND l.toxic IS NULL AS tier_two FROM {LABELLED}")
def tier_gate(spark, sf):
    d = labelled(spark, sf)
    q, t = F.col("quality").cast("string"), F.col("toxic").cast("string")
    return d.select("doc_id", models.needs_tier_one(F.col("text"), q).alias("tier_one"), models.needs_tier_two(F.col("text"), t, F.lit("x")).alias("tier_two"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS tier FROM events")
def task_routing(spark, sf):
    task = F.when(F.col("event_id") % 3 == 0, "explain_code").when(F.col("event_id") % 3 == 1, "classify_topic").otherwise("anything")
    return read(spark, sf, "events").select("event_id", models.tier(task).alias("tier"))


# ---- streams


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, count(*) AS n, CAST(epoch(max(ts)) - epoch(min(ts)) AS BIGINT) AS seconds FROM s GROUP BY user_id, sid""")
def sessionized_batches(spark, sf):
    s = streams.session_batches(read(spark, sf, "events"), "ts", "user_id", "30 minutes")
    return s.select("user_id", "n", F.round(F.col("end").cast("timestamp").cast("double") - 1800 - F.col("start").cast("timestamp").cast("double")).cast("long").alias("seconds"))


@query("""SELECT event_id, CASE WHEN p IS NULL THEN 'created' ELSE 'modified' END AS kind FROM (SELECT event_id, event_id % 100 AS m, max(event_id % 100) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM events) WHERE p IS NULL OR m > p""")
def mtime_change_detect(spark, sf):
    listing = read(spark, sf, "events").select("event_id", "user_id", (F.col("event_id") % 100).alias("mtime"))
    return streams.modified(listing, "user_id", "mtime", "event_id").select("event_id", "kind")


@query("SELECT event_id, digest FROM (SELECT event_id, substr(sha256(event_type), 1, 16) AS digest, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p, event_type FROM events) WHERE p IS NULL OR p <> event_type")
def hash_change_detect(spark, sf):
    return streams.changed(read(spark, sf, "events"), "user_id", "event_id", identity.hash16(F.col("event_type"))).select("event_id", "digest")


def _stream_folder(spark) -> str:
    import uuid

    graph.shared_folder(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"


def _ended(spark, sf, name: str, shape) -> DataFrame:
    """A stream over a table run to its end, in the shared folder."""
    base = _stream_folder(spark)
    # a file source reads folders: the table's one file is put into one
    read(spark, sf, name).write.parquet(f"{base}/in")
    return streams.run_to_end(shape(streams.table_stream(spark, f"{base}/in")), f"{base}/out", f"{base}/state")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    return _ended(spark, sf, "events", lambda s: streams.first_seen(s.select("user_id", "event_type"), ["user_id", "event_type"]))


@query("""WITH u AS (SELECT user_id % 7 AS shard, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1), f AS (SELECT shard, n, unnest(range(0, (n + 49) // 50)) AS flush FROM u)
SELECT flush, count(*) AS shards, CAST(sum(least(50, n - 50 * flush)) AS BIGINT) AS n, (SELECT count(*) FROM events WHERE user_id IS NOT NULL) AS ids FROM f GROUP BY flush""")
def flush_batches(spark, sf):
    """Exports of 50 rows of each of seven shards, and what they hold at the end, by number of the flush."""
    base = _stream_folder(spark)
    read(spark, sf, "events").where("user_id is not null").withColumn("part", F.pmod("user_id", F.lit(7))).write.parquet(f"{base}/in")
    stream = streams.table_stream(spark, f"{base}/in")
    flush.drain(stream, flush.FlushPolicy(flush.EXPORT.rows, 1e9), f"{base}/f", f"{base}/state", shards=7, key="part")
    out = flush.flushed(spark, f"{base}/f")
    ids = out.agg(F.countDistinct("event_id").alias("ids"))
    return out.groupBy("flush").agg(F.countDistinct("shard").alias("shards"), F.count("*").alias("n")).crossJoin(ids)  # one row


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def stream_counts(spark, sf):
    return stats.counts(_ended(spark, sf, "events", lambda s: s.select("event_id", "event_type")), "event_type")


# ---- records


@query("""SELECT 'conv_' || conv_id || '_' || turn AS id, text AS content, CASE WHEN turn % 10 = 0 THEN 'beginner' WHEN turn % 10 <= 2 THEN 'beginner' WHEN turn % 10 <= 4 THEN 'intermediate' WHEN turn % 10 <= 7 THEN 'advanced' ELSE 'expert' END AS difficulty,
CASE role WHEN 'user' THEN 'sop' ELSE 'dop' END AS context, sha256(text || chr(10) || role) AS checksum FROM conversations""")
def migrate_v1(spark, sf):
    c = read(spark, sf, "conversations")
    old = F.to_json(F.struct(F.concat_ws("_", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("role").alias("code"), (F.col("turn") % 10).alias("difficulty"),
        F.struct(F.col("text").alias("explanation")).alias("generation"), F.struct(F.when(F.col("role") == "user", "point").otherwise("DOP").alias("context")).alias("classification")))
    return records.migrate(c.select(old.alias("value"))).select("id", "content", "difficulty", F.element_at("vex_context", 1).alias("context"), "checksum")


@query(r"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([regexp_replace('@@' || lang, '^@+', ''), regexp_replace(source, '^@+', ''), ''], lambda a: a <> ''))), ',') AS names FROM documents")
def attribute_names(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", F.array_join(C.plain_attributes(F.array(F.concat(F.lit("@@"), F.col("lang")), F.col("source"), F.lit("@"))), ",").alias("names"))


# ---- generic relational shapes


@query("""SELECT c_mktsegment AS segment, count(*) AS orders, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_mktsegment""")
def relational_smoke(spark, sf):
    c, o, l = (read(spark, sf, n) for n in ("customer", "orders", "lineitem"))
    joined = l.join(o, l.l_orderkey == o.o_orderkey).join(c, c.c_custkey == o.o_custkey)
    return joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT c_custkey, c_name, round(c_acctbal, 2) AS balance, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r <= 3")
def relational_topk(spark, sf):
    order = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    c = read(spark, sf, "customer").withColumn("rank", F.row_number().over(order)).where("rank <= 3")
    return c.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("balance"), "rank")


from . import answers, reports  # noqa: E402, F401  their queries are registered here too


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """BM25 over documents for a batch of questions."""
    return bm25_topk(spark, sf)
