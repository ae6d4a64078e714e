import json

from pyspark.sql import functions as F

from lodestone.operators import dedup, evaluate, export, models, records
from lodestone.operators.graph import connected_components
from lodestone.plans.stages import Plan
from lodestone.sources import files, html
from lodestone.streaming import streams


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_pairs_and_actions(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l", "x", 0.1), (2, "a b c d e f g h i j k l", "y", 0.9), (3, "a b c d e f g h i j k m", "y", 0.5), (4, "z", "x", 1.0)], "id long, text string, source string, authority double")
    pairs = dedup.jaccard_pairs(dedup.shingle_sets(docs, "id", F.col("text")), 0.5)
    assert [(r.a, r.b, round(r.similarity, 3)) for r in pairs.collect()] == [(1, 3, 0.818)]
    acted = dedup.actions(dedup.with_sources(pairs, docs)).collect()
    assert [(r.action, r.keep) for r in acted] == [("LINK", 3)]
    assert dedup.first_wins(docs, F.col("text"), [F.col("id")]).count() == 3


def test_votes(spark):
    rows = [("t", 1, "a"), ("t", 2, "b"), ("t", 3, None), ("u", 1, "x"), ("u", 2, "x"), ("u", 3, "y")]
    got = {r.task_id: (r.winner, r.votes, r.asked) for r in models.consensus(spark.createDataFrame(rows, "task_id string, ord int, vote string")).collect()}
    assert got == {"t": ("a", 1, 3), "u": ("x", 2, 3)}


def test_fallbacks(spark):
    def model(name, task, text):
        if name == "first":
            raise TimeoutError
        return '```json\n{"context": "point"}\n```'

    tasks = spark.createDataFrame([("1", "classify_topic", "x")], "task_id string, task string, input string")
    known = spark.createDataFrame([(1, "first", ["second"])], "tier int, model string, fallbacks array<string>")
    r = models.call_models(models.route(tasks, known), model).first()
    assert (r.status, json.loads(r.result), r.model_used, r.fallback_used) == ("success", {"context": "point"}, "second", True)


def test_markdown(spark, tmp_path):
    (tmp_path / "Guide.md").write_text("intro\n\n# One\ntext\n```vex\n# not a heading\n@P = 1;\n```\nmore\n\n## Two\n```python\nprint(1)\n```\n", encoding="utf-8")
    rows = files.markdown_chunks(files.directory(spark, str(tmp_path))).orderBy("id").collect()
    assert [(r.id, r.title, r.content, r.codes) for r in rows] == [
        ("local_local-skill_guide_001", "Guide", "intro", []),
        ("local_local-skill_guide_002", "One", "text\n\nmore", ["# not a heading\n@P = 1;"]),
    ]


def test_code_and_snapshots(spark, tmp_path):
    (tmp_path / "a.vex").write_text(" @P = 1; \n")
    (tmp_path / "b.vex").write_text("@P = 1;")
    assert files.samples(files.code_files(spark, str(tmp_path))).count() == 1
    (tmp_path / "corpus_1.json").write_text(json.dumps({"samples": [{"id": "x", "code": "1"}, {"id": "x", "code": "2"}]}))
    (tmp_path / "corpus_2.json").write_text("{broken")
    assert [r.id for r in files.snapshots(spark, str(tmp_path)).collect()] == ["x"]
    assert files.preferred_files(["b.jsonl", "z_all.jsonl", "a_all.jsonl"]) == ["a_all.jsonl"]


def test_html():
    page = "<script>x()</script><h1>T &amp; x</h1><p>a <code>b</code></p><pre>int x;</pre><p>prev: y</p><h2>U</h2>"
    assert html.sections(page) == [("T & x", "a b", ["int x;"])]


def test_migration_and_tags(spark):
    old = spark.createDataFrame([(json.dumps({"id": "joy_of_vex_ep07_1", "code": "@P;", "difficulty": 6, "generation": {"explanation": "e"}, "source_file": "https://youtube.com/x"}),), ("{bad",)], "value string")
    r = records.migrate(old).first()
    assert (r.difficulty, r.section, r.source_authority, r.content) == ("advanced", "Joy of VEX Day 7", 0.9, "e")


def test_sync_is_idempotent(spark, tmp_path):
    columns = "topic string, id string, title string, difficulty string, source_id string, code string, content string, functions_referenced array<string>"
    df = spark.createDataFrame([("edge_ops", "1", "A", "beginner", "s", "x = 1;", "Does it. More", ["Noise", "abs "])], columns)
    (tmp_path / "own.md").write_text("mine")
    (tmp_path / "corpus_old.md").write_text("stale")
    (tmp_path / "semantic_index.json").write_text(json.dumps({"karma": {"summary": "k"}, "corpus_old": {"summary": "o"}}))
    (tmp_path / "agent_relevance_map.json").write_text(json.dumps({"karma": "lop_agent", "corpus_old": "sop_agent"}))
    first = export.sync(df, str(tmp_path))
    assert first["written"] == ["corpus_edge_ops.md"] and first["deleted"] == ["corpus_old.md"]
    assert export.sync(df, str(tmp_path))["skipped"] and (tmp_path / "own.md").exists()
    assert "### A" in (tmp_path / "corpus_edge_ops.md").read_text()
    entry = {"summary": "Corpus: Edge Ops (1 examples)", "description": "Labeled examples for edge ops. Sources: s. Covers 1 code snippets with difficulty ratings and metadata.", "keywords": ["abs", "noise"], "reference_file": "corpus_edge_ops"}
    assert json.loads((tmp_path / "semantic_index.json").read_text()) == {"karma": {"summary": "k"}, "corpus_edge_ops": entry}
    assert json.loads((tmp_path / "agent_relevance_map.json").read_text()) == {"karma": "lop_agent", "corpus_edge_ops": "sop_agent"}
    assert {p.name for p in tmp_path.iterdir()} == {"own.md", "corpus_edge_ops.md", "semantic_index.json", "agent_relevance_map.json", "manifest.json"}
    assert not export.sync(df.withColumn("title", F.lit("B")), f"file:{tmp_path}")["skipped"] and "### B" in (tmp_path / "corpus_edge_ops.md").read_text()


def test_metrics(spark):
    results = spark.createDataFrame([("q", 1, 1), ("q", 2, 2)], "query_id string, id int, rank int")
    judged = spark.createDataFrame([("q", 2), ("q", 9)], "query_id string, id int")
    r = evaluate.metrics(results, judged).first()
    assert (r.p_all, r.recall, r.mrr, r.verdict) == (0.5, 0.5, 0.5, "PASS")


def test_stage_runner(spark, tmp_path):
    plan = Plan(str(tmp_path), [("one", lambda s, d: d), ("two", lambda s, d: d.limit(1)), ("llm", lambda s, d: d)], {"llm"})
    assert plan.run(spark, spark.range(3)) == ["one", "two"]
    assert plan.chosen("two") == ["two", "llm"] and plan.chosen(only="llm") == ["llm"]
    assert spark.read.parquet(plan.table("two")).count() == 1


def test_staged_stream(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = streams.table_stream(spark, str(tmp_path / "in"), 10)
    streams.staged(stream, [lambda d: d.where("id > 2")], str(tmp_path / "out"), str(tmp_path / "state"), F.col("id") > 7).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/complete")).count() == 5
    assert spark.read.parquet(str(tmp_path / "out/review")).count() == 2


def test_estimates_do_not_grow_with_the_rounds_of_a_chain(spark):
    """Checkpoints kept estimates that doubled their digits each round, until the driver was full."""
    found = connected_components(spark.range(200).selectExpr("id AS a", "id + 1 AS b"))
    assert found.where("component = 0").count() == 201
    estimate = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert (estimate.bit_length() if isinstance(estimate, int) else estimate.bitLength()) < 64
