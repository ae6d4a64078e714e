import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import dedup, export, graph, reports, stats

CHUNKS = "id string, content string, code_blocks array<struct<code:string>>, content_type string, difficulty string, source_id string, title string, functions_referenced array<string>, llm_topic string, llm_bugs array<string>, llm_complexity string, prompt string, explanation string, code string"


@pytest.fixture
def chunks(spark):
    rows = [
        ("a", "text", [("12345",), ("x",)], "concept", "beginner", "s1", "A", ["f", "g"], "noise", [], "O(1)", "p", "", "0123456789"),
        ("b", None, None, None, "", "s2", "B", None, "", None, None, "", "e", "short"),
        ("c", "abc", [], "concept", "expert", "s1", "C", ["g"], "noise", ["x"], "", None, None, ""),
        ("d", "", [("z",)], "pattern", "expert", "s1", "D", [], "edges", None, "", "", "", "abcdefghijk"),
    ]
    return spark.createDataFrame(rows, CHUNKS)


def read(path):
    return json.loads(path.read_text(encoding="utf-8"))


def lines(folder):
    return [json.loads(x) for p in sorted(folder.glob("**/*.json")) for x in p.read_text(encoding="utf-8").splitlines()]


def test_statistics(spark, chunks):
    one = reports.corpus_stats(chunks).first()
    assert (one.total_chunks, one.with_code, one.total_code_blocks, one.unique_functions, one.avg_chunk_length) == (4, 2, 3, 2, 3)
    clean = reports.cleaned_stats(chunks, F.col("code")).first()
    assert (clean.with_code, clean.llm_topic, clean.llm_bugs, clean.llm_complexity, clean.prompt, clean.explanation) == (2, 3, 2, 1, 1, 1)
    assert [(r.topic, r.n) for r in reports.topic_distribution(chunks).collect()] == [("noise", 2), ("edges", 1)]
    assert reports.counted(chunks, "content_type") == {"concept": 2, "pattern": 1, "unknown": 1} and reports.counted(chunks, "difficulty")[""] == 1
    assert stats.counts(spark.createDataFrame([], "a string"), "a").count() == 0


def test_merged_corpus(spark, chunks, tmp_path):
    pairs = spark.createDataFrame([("a", "c", 0.9)], "a string, b string, similarity double")
    reports.write_merged(chunks, pairs, str(tmp_path), 0.85, "1")
    assert [list(x) for x in lines(tmp_path / "merged")][0] == sorted(x for x in lines(tmp_path / "merged")[0])
    assert {x["id"] for x in lines(tmp_path / "directory")} == set("abcd") and read(tmp_path / "manifest.json")["dedup_pairs"] == 1
    assert read(tmp_path / "stats.json")["by_source"] == {"s1": 3, "s2": 1} and read(tmp_path / "dedup_report.json")["pairs_found"] == 1
    reports.write_merged(chunks, pairs.limit(0), str(tmp_path / "none"), 0.85)
    assert not (tmp_path / "none" / "dedup_report.json").exists()
    assert reports.write_cleaned_stats(chunks, F.col("code"), str(tmp_path / "clean.json"))["by_llm_topic"] == {"noise": 2, "edges": 1}


def test_corpus_and_exports(spark, tmp_path):
    cols = "id string, stage string, context string, topic string, difficulty string, confidence double, flagged_for_review boolean, prompt string, code string"
    rows = [("1", "complete", "sop", "t", "expert", 0.9, False, "p", "c"), ("2", "complete", None, None, None, 0.1, True, "q", "d"), ("3", "pending", "sop", "", "", None, None, "", "e")]
    df = spark.createDataFrame(rows, cols)
    assert {k: v for k, v in reports.write_corpus(df, str(tmp_path / "c")).items() if k != "generated_at"} == {"total_samples": 2, "flagged_for_review": 1}
    assert {x["id"] for x in lines(tmp_path / "c" / "samples")} == {"1", "2"}
    reports.export_all(df, str(tmp_path / "all"))
    assert [x["prompt"] for x in lines(tmp_path / "all" / "training")] == ["p"] and len(lines(tmp_path / "all" / "chat")[0]["messages"]) == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "all" / "metadata")).count() == 2 and spark.read.parquet(str(tmp_path / "all" / "parquet")).count() == 2
    got = {(r.measure, r.value): r.n for r in reports.stage_report(df).collect()}
    assert got["stage", "complete"] == 2 and got["stage", "tier1"] == 0 and got["context", "unknown"] == 1 and got["topic", "unknown"] == 2 and got["all", "flagged_for_review"] == 1 and got["all", "with_prompts"] == 2
    assert reports.browse(df.withColumn("id", F.lit("x" * 20))).first().id == "x" * 16


def test_dedup_reports(spark, tmp_path):
    acted = spark.createDataFrame([(1, 2, 0.99, "DROP", "x", "y"), (2, 3, 0.8, "LINK", "x", "x"), (4, 5, 0.92, "MERGE", "x", "y")], "a long, b long, similarity double, action string, source_a string, source_b string")
    r = dedup.report_stats(acted, dedup.membership(acted), 7, 2, 0.8)
    out = reports.write_dedup_report(acted, r, str(tmp_path))
    assert (out["pairs"], out["drop"], out["merge"], out["clusters"], out["indexed"], out["skipped"], out["cross_source"]) == (3, 1, 1, 2, 7, 2, 2)
    assert [x["action"] for x in lines(tmp_path / "actions")] == ["DROP", "MERGE"] and [x["similarity"] for x in lines(tmp_path / "pairs")] == [0.99, 0.92, 0.8]
    reports.write_dedup_report(acted.where("action = 'LINK'"), r, str(tmp_path / "quiet"))
    assert not (tmp_path / "quiet" / "actions").exists()
    links = dedup.link_counts(spark.createDataFrame([(1, 4)], "a long, b long"), spark.createDataFrame([(1, 1), (2, 1), (4, 4), (9, 9)], "id long, class long"))
    assert {r.id: r.links for r in links.collect()} == {1: 1, 2: 1, 4: 2, 9: 0}
    without = dedup.actions(spark.createDataFrame([(1, 2, 0.92, None, 0.1)], "a long, b long, similarity double, authority_a double, authority_b double"), merge=False).first()
    assert (without.action, without.keep) == ("LINK", 2)


def test_tagging_and_extraction_reports(spark, tmp_path):
    tagged = spark.createDataFrame([(["difficulty: a -> b", "content_type: x -> y"], "y", "b", ["sop", "dop"], "18.0"), ([], "y", "b", None, "")], "decisions array<string>, content_type string, difficulty string, vex_context array<string>, houdini_version_min string")
    got = {(r.measure, r.value): r.n for r in reports.tagging_summary(tagged).collect()}
    assert got == {("changed", "difficulty"): 1, ("changed", "content_type"): 1, ("content_type", "y"): 2, ("difficulty", "b"): 2, ("vex_context", "sop"): 2, ("vex_context", "dop"): 1, ("all", "with_version"): 1}
    reports.write_decision_log(tagged, str(tmp_path / "log"))
    assert {x["decision"] for x in lines(tmp_path / "log")} == {"difficulty: a -> b", "content_type: x -> y"}
    before = spark.createDataFrame([(["a"], None), (None, ["w"])], "functions_referenced array<string>, validation_warnings array<string>")
    after = spark.createDataFrame([(["a", "b"], ["x"]), ([], ["w", "v"])], "functions_referenced array<string>, validation_warnings array<string>")
    r = reports.extraction_summary(before, after).first()
    assert (r.functions_added, r.chunks_with_functions, r.chunks, r.unique_functions, r.warnings_added) == (1, 1, 2, 2, 2)


def test_other_summaries(spark):
    got = {(r.measure, r.value): r.n for r in reports.import_summary(spark.createDataFrame([(1, True), (1, None), (5, False)], "difficulty int, flagged_for_review boolean")).collect()}
    assert got == {("difficulty", "1"): 2, ("difficulty", "5"): 1, ("all", "flagged_for_review"): 1}
    r = {x.model: (x.avg_seconds, x.avg_rate, x.success_rate) for x in reports.model_summary(spark.createDataFrame([("m", 1.0, 10.0, True), ("m", 2.0, 30.0, False)], "model string, seconds double, tokens_per_sec double, success boolean")).collect()}
    assert r == {"m": (1.5, 20.0, 0.5)}
    w = {x.worker: (x.processed, x.failed, x.avg_ms, x.success_rate) for x in reports.worker_summary(spark.createDataFrame([("a", True, 10.0), ("a", False, 99.0), ("b", None, None)], "worker string, ok boolean, ms double")).collect()}
    assert w == {"a": (1, 1, 10.0, 0.5), "b": (0, 0, 0.0, 1.0)}
    rates = spark.createDataFrame([(10.0, 1.0), (10.0, 3600.0)], "n double, s double").select(reports.hourly_rate(F.col("n"), F.col("s")).alias("r"))
    assert [x.r for x in rates.collect()] == [0.0, 10.0]
    errors = spark.createDataFrame([(i, i % 2) for i in range(10)], "at int, g int")
    assert [x["at"] for x in reports.recent(errors, "at", 3).collect()] == [9, 8, 7] and sorted(x["at"] for x in reports.recent(errors, "at", 1, "g").collect()) == [8, 9]
    assert [x["at"] for x in reports.first_rows(errors, ["at"], 2).collect()] == [0, 1]


def test_graph_and_evaluation(spark, tmp_path):
    edges = spark.createDataFrame([("x", "a", "concept"), ("x", "b", "mention"), ("y", "a", "episode")], "src string, dst string, rule string")
    intros = spark.createDataFrame([("noise", "a", 1), ("noise", "b", 2)], "concept string, id string, place int")
    chunks = spark.createDataFrame([("a", 1, 3), ("b", 1, 1), ("c", None, 0), ("d", 2, 9)], "id string, episode int, ord int")
    episodes = graph.first_of_episodes(chunks)
    assert {(r.episode, r.id) for r in episodes.collect()} == {(1, "b"), (2, "d")}
    assert reports.write_graph(edges, intros, episodes, str(tmp_path)) == {"chunks_with_prereqs": 2, "total_links": 3, "concepts": 1, "episodes": 2}
    assert {x["id"]: x["prerequisites"] for x in lines(tmp_path / "prerequisites")} == {"x": ["a", "b"], "y": ["a"]} and lines(tmp_path / "introductions")[0]["introductions"] == ["a", "b"]
    said = graph.mentions(spark.createDataFrame([("p", "see Joy of VEX 12, jov3 and JoyOfVex 12"), ("q", "none")], "id string, t string"), F.col("t"))
    assert {(r.id, r.episode) for r in said.collect()} == {("p", 12), ("p", 3)}
    merged = graph.merge_prerequisites(spark.createDataFrame([("x", ["c", "a"]), ("z", None)], "id string, prerequisites array<string>"), edges)
    assert {r.id: r.prerequisites for r in merged.collect()} == {"x": ["a", "b", "c"], "z": []}
    per = spark.createDataFrame([("q1", 0.4, 0.5, 0.2, 1.0, 0.7, 0.6, "PASS"), ("q2", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "FAIL")], "query_id string, p_first double, p_all double, recall double, mrr double, ndcg double, ndcg_full double, verdict string")
    out = reports.write_evaluation(per, spark.createDataFrame([("q1", False)], "query_id string, has_required boolean"), {"top_k": 10}, str(tmp_path / "eval.json"))
    assert out["config"] == {"top_k": 10, "n_queries": 2} and out["aggregate"]["pass_rate"] == 0.5 and out["aggregate"]["function_match_rate"] == 0.5 and read(tmp_path / "eval.json")["per_query"][0]["query_id"] == "q1"


def test_jobs_pages_and_versions(spark, tmp_path):
    jobs = spark.createDataFrame([("j", "classify", "x", "{}", 0.9, "success", 1.0, 3.5), ("k", "classify", "y", None, None, "error", None, None)], "job_id string, task_type string, input string, result string, confidence double, status string, started_at double, completed_at double")
    reports.write_job_results(jobs, str(tmp_path / "jobs"))
    assert [(x["job_id"], x["processing_time"]) for x in lines(tmp_path / "jobs")] == [("j", 2.5)]
    pages = spark.createDataFrame([("a", "p1"), ("b", "p1"), ("c", "p2")], "id string, page string")
    reports.write_by_page(pages, "page", str(tmp_path / "pages"))
    assert {p.name for p in (tmp_path / "pages" / "pages").glob("page=*")} == {"page=p1", "page=p2"} and len(lines(tmp_path / "pages" / "all")) == 3
    folder = str(tmp_path / "store")
    reports.rewrite(spark, folder, "corpus", pages)
    reports.rewrite(spark, folder, "corpus", reports.current(spark, folder, "corpus").where("id <> 'a'"))
    assert reports.current(spark, folder, "corpus").count() == 2
    reports.write_index_metadata(spark.createDataFrame([("a", "T", "s", "concept", "expert", "x" * 300)], "id string, title string, source_id string, content_type string, difficulty string, content string"), str(tmp_path / "meta"))
    assert len(spark.read.parquet(str(tmp_path / "meta")).first().content) == 200


def test_misc_page_and_sparse_rows(spark):
    rows = [("small", "2", "Two", "expert", "s2", " ", "Second one. Rest"), ("edge_ops", "1", "One", "beginner", "s1", "x;", ""), ("small", "1", None, None, "s1", None, None)]
    page = export.misc_page(spark.createDataFrame(rows, "topic string, id string, title string, difficulty string, source_id string, code string, content string"), {"s1": "first"}).first().page
    assert page == "# Corpus: Miscellaneous Topics\n\n> 3 examples from corpus (small topics). Sources: first, s2\n\n## Edge Ops (1 examples)\n\n### One\n\n```vex\nx;\n```\n\n## Small (2 examples)\n\n### Two\n\nSecond one.\n\n### 1\n\n"
    df = spark.createDataFrame([("a", "", 0, False, []), ("b", "t", 2, True, ["x"])], "id string, t string, n int, f boolean, l array<string>")
    assert [json.loads(r.j) for r in df.select(export.sparse(df, df.columns).alias("j")).collect()] == [{"id": "a"}, {"id": "b", "t": "t", "n": 2, "f": True, "l": ["x"]}]


def test_entries_of_a_topic_are_rows(spark, tmp_path):
    rows = [("t", str(i), f"T{i}", "expert" if i % 2 else "beginner", "s", "", f"text {i}") for i in range(9)] + [("u", "1", "U", "odd", "s", "", "x")]
    df = spark.createDataFrame(rows, "topic string, id string, title string, difficulty string, source_id string, code string, content string")
    export.write_entries(df, str(tmp_path / "pages"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "pages" / "topic=t").glob("part-*")))
    assert [x for x in text.split() if x.startswith("T")] == [f"T{i}" for i in (0, 2, 4, 6, 8, 1, 3, 5, 7)]
    assert not (tmp_path / "pages" / "topic=u").exists()
