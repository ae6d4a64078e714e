import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import enrich, models, records


def variants(spark, rows):
    return spark.createDataFrame(rows, "id string, j string, error string").select("id", F.try_parse_json("j").alias("r"), "error")


SHAPES = [
    ("a", {"topic": "noise", "bugs": [{"type": "x", "severity": "low"}], "complexity": "O(1)"}, None),
    ("b", {"topic": {"primary": "edges", "secondary": ["m"]}, "bugs": {"issues": [{"type": "y"}], "quality": "good"}, "complexity": {"class": "O(n)", "bottlenecks": ["loop"]}}, None),
    ("c", {"topic": {"primary_topic": "p", "secondary_topics": ["s"]}, "bugs": {"bugs": [], "overall_quality": "fine"}, "complexity": {"complexity": "O(2)"}}, None),
    ("d", {}, None), ("e", {"topic": "ignored"}, "timeout"), ("f", {"bugs": []}, None),
]


def test_first_tier_answers_in_any_shape(spark):
    chunks = spark.createDataFrame([(i, "old") for i in "abcdefg"], "id string, llm_topic string")
    got = {r.id: (r.llm_topic, r.llm_secondary_topics, [b.type for b in r.llm_bugs] if r.llm_bugs is not None else None, r.llm_code_quality, r.llm_complexity, r.llm_bottlenecks) for r in enrich.apply_tier_one(chunks, variants(spark, [(i, json.dumps(x), e) for i, x, e in SHAPES])).collect()}
    assert got == {
        "a": ("noise", [], ["x"], "minor_issues", "O(1)", []), "b": ("edges", ["m"], ["y"], "good", "O(n)", ["loop"]), "c": ("p", ["s"], [], "fine", "O(2)", []), "d": ("", [], [], "unknown", "unknown", []),
        "e": ("old", None, None, None, None, None), "f": ("", [], [], "clean", "unknown", []), "g": ("old", None, None, None, None, None),
    }


def test_second_tier_never_overwrites(spark):
    chunks = spark.createDataFrame([("a", "mine", [], "", ["k"]), ("b", "", ["x"], None, None)], "id string, prompt string, alternative_prompts array<string>, explanation string, llm_key_concepts array<string>")
    answer = json.dumps({"prompt": "new", "alternative_prompts": ["n"], "explanation": "e", "key_concepts": ["z"]})
    got = {r.id: tuple(r)[1:] for r in enrich.apply_tier_two(chunks, variants(spark, [("a", answer, None), ("b", answer, None)])).collect()}
    assert got == {"a": ("mine", ["n"], "e", ["z"]), "b": ("new", ["x"], "e", ["z"])}


def test_answers_are_parsed_or_errors(spark):
    got = {r.id: (r.error, r.v) for r in enrich.parsed_results(spark.createDataFrame([("a", '```json\n{"x": 1}\n```'), ("b", "sorry"), ("c", None)], "id string, answer string")).select("id", "error", F.to_json("r").alias("v")).collect()}
    assert got == {"a": (None, '{"x":1}'), "b": ("JSON parse: sorry", None), "c": ("JSON parse: ", None)}


def test_enrichment_goes_on_where_it_was(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    cols = "id string, code string, llm_topic string, prompt string, explanation string"
    chunks = spark.createDataFrame([(f"c{i}", "x" * (5 if i == 0 else 20), "known" if i == 1 else "", "", "") for i in range(9)], cols)

    def model(tier, code, log=str(log)):
        import os
        import tempfile

        os.close(tempfile.mkstemp(dir=log)[0])
        return json.dumps({"topic": "t", "bugs": [], "complexity": "O(1)", "prompt": "p", "explanation": "e"})

    done = enrich.enrich(chunks, F.col("code"), model, str(tmp_path / "run"), 1, batch=3, limit=4)
    assert done.where("llm_topic = 't'").count() == 4 and len(list(log.iterdir())) == 4
    done = enrich.enrich(chunks, F.col("code"), model, str(tmp_path / "run"), 1, batch=3, limit=2)  # two more, not the same again
    assert done.where("llm_topic = 't'").count() == 6 and len(list(log.iterdir())) == 6
    done = enrich.enrich(chunks, F.col("code"), model, str(tmp_path / "run"), 1, batch=3)
    assert done.where("llm_topic = 't'").count() == 7 and len(list(log.iterdir())) == 7
    assert enrich.enrich(chunks, F.col("code"), model, str(tmp_path / "run"), 2).where("prompt = 'p'").count() == 8

    def broken(tier, code):
        raise TimeoutError("no answer")

    assert enrich.enrich(chunks, F.col("code"), broken, str(tmp_path / "other"), 1).where("llm_topic = 't'").count() == 0


def test_calls_in_flight_are_bounded(spark, tmp_path):
    now, most = tmp_path / "now", tmp_path / "most"
    now.mkdir()
    most.mkdir()
    chunks = spark.createDataFrame([(f"c{i}", "x" * 20, "", "", "") for i in range(40)], "id string, code string, llm_topic string, prompt string, explanation string")

    def model(tier, code, now=str(now), most=str(most)):
        import os
        import tempfile
        import time

        handle, name = tempfile.mkstemp(dir=now)
        os.close(handle)
        time.sleep(0.05)
        open(f"{most}/{len(os.listdir(now))}", "w").close()
        time.sleep(0.05)
        os.unlink(name)
        return json.dumps({"topic": "t"})

    done = enrich.enrich(chunks, F.col("code"), model, str(tmp_path / "run"), 1, batch=40, in_flight=6)
    assert done.where("llm_topic = 't'").count() == 40
    assert 2 <= max(int(p.name) for p in most.iterdir()) <= 6


def test_a_batch_of_many_texts_is_cut(spark, tmp_path, monkeypatch):
    """One batch of 80 texts of 1,000 bytes, of which a task may have 5,000: calls at once stay as few, and no task is given much more."""
    seen = tmp_path / "seen"
    seen.mkdir()
    monkeypatch.setattr(enrich, "PART_BYTES", 5_000)
    chunks = spark.createDataFrame([(f"s{k}", "x" * 1_000) for k in range(80)], "id string, code string").withColumn("llm_topic", F.lit(None).cast("string"))

    def model(tier, code, seen=str(seen)):
        from pyspark import TaskContext

        c = TaskContext.get()
        open(f"{seen}/{c.stageId()}-{c.partitionId()}-{len(os.listdir(seen))}-{os.urandom(8).hex()}", "w").close()
        return json.dumps({"topic": "t"})

    import os

    done = enrich.enrich(chunks, F.col("code"), model, str(tmp_path / "run"), 1, batch=1 << 40)
    assert done.where("llm_topic = 't'").count() == 80 and len(os.listdir(seen)) == 80
    tasks = [tuple(p.split("-")[:2]) for p in os.listdir(seen)]
    assert max(map(tasks.count, set(tasks))) <= 16 and len({s for s, _ in tasks}) >= 6
    assert {p.name for p in (tmp_path / "run").iterdir()} == {"tier1"}


def test_warnings_are_of_each_block(spark):
    blocks = ["int a = 1;\nint b = 2", None, "", "if (x) {", "}"]
    chunks = spark.createDataFrame([(blocks, ["old"], ["f"]), (None, None, None)], "codes array<string>, validation_warnings array<string>, functions_referenced array<string>")
    got = [r.validation_warnings for r in records.extract(chunks, None, F.col("codes")).collect()]
    assert got == [["old", "Line 2: possible missing semicolon: int b = 2", "Unclosed braces: 1 more { than }", "Extra closing braces: 1 more } than {"], []]


def test_jobs_that_fail_go_back_into_the_queue(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(name, task, text, calls=str(calls)):
        import os
        import tempfile

        os.close(tempfile.mkstemp(dir=calls, prefix=f"{text}-")[0])
        n = len([f for f in os.listdir(calls) if f.startswith(f"{text}-")])
        if text == "never" or (text == "third" and n < 3):
            raise TimeoutError
        return json.dumps({"n": n})

    tasks = [("t1", "classify_wrangle", "first"), ("t2", "classify_wrangle", "third"), ("t3", "classify_wrangle", "never"), ("t4", "no such task", "unserved")]
    jobs = spark.createDataFrame(tasks, "task_id string, task string, input string")
    models = spark.createDataFrame([(1, "m", [])], "tier int, model string, fallbacks array<string>")
    models = models.unionByName(spark.createDataFrame([], models.schema))
    got = {r.task_id: (r.status, r.retries) for r in enrich.run_queue(jobs, models, model, str(tmp_path / "q"), most_retries=3).collect()}
    assert got["t1"] == ("success", 0) and got["t2"] == ("success", 2) and got["t3"] == ("error", 3) and len(got) == 4
    assert len([p for p in calls.iterdir() if p.name.startswith("never")]) == 4


def answering(name, task, text):
    if name == "bad":
        raise TimeoutError
    return json.dumps({"context": "point" if name == "m1" else "prim", "primary_topic": name[0], "complexity": name, "difficulty": 5 if name == "m1" else 4, "bugs": [{"type": "b"}, {"type": "a"}]})


@pytest.fixture
def known(spark):
    return spark.createDataFrame([(1, "m1", ["m2", "bad", "m3"]), (2, "big", [])], "tier int, model string, fallbacks array<string>")


def test_jobs_of_two_tiers(spark, known):
    samples = spark.createDataFrame([("s1", "x", False), ("s2", "y", True)], "id string, code string, flagged_for_review boolean")
    jobs = enrich.job_list(samples)
    assert jobs.count() == 12 and {r.job_id for r in jobs.where("tier = 2").collect()} == {"s1_explain", "s1_prompt", "s2_explain", "s2_prompt"}
    one, two = enrich.run_two_tiers(samples, known, answering)
    assert one.count() == 8 and {r.task_id for r in two.collect()} == {"s1_explain", "s1_prompt"}
    table = enrich.job_table(jobs, one.unionByName(two))
    stats = enrich.queue_stats(table).first()
    assert (stats.total, stats.pending, stats.completed, stats.failed) == (12, 2, 10, 0) and stats.per_minute >= 0
    assert len(list(enrich.result_stream(one))) == 8
    order = [r.job_id for r in models.by_priority(jobs.withColumn("ord", F.col("job_id"))).orderBy("turn").collect()]
    assert order[-1].startswith("s2_") and set(order[:8]) == {r.job_id for r in jobs.where("tier = 1").collect()}


def test_votes_of_several_models(spark, known):
    tasks = spark.createDataFrame([("t1", "classify_topic", "x"), ("t2", "rate_difficulty", "x"), ("t3", "detect_bugs", "x"), ("t4", "extract_functions", "x")], "task_id string, task string, input string")
    got = {r.task_id: (r.winner, r.votes, r.asked, json.loads(r.result)["complexity"]) for r in models.vote(tasks, known, answering).collect()}
    assert got["t1"] == ("m", 2, 3, "m1") and got["t3"] == ("a,b", 2, 3, "m1") and "t4" not in got
    keyed = spark.createDataFrame([(5.0,), (3.0,), (1.0,)], "d double").select(models.vote_key(F.lit("rate_difficulty"), F.try_parse_json(F.to_json(F.struct(F.col("d").alias("difficulty"))))).alias("k"))
    assert [r.k for r in keyed.collect()] == ["4", "4", "0"]


def test_gates(spark):
    df = spark.createDataFrame([(1, "pending", None, "x"), (2, None, True, ""), (3, "tier1", False, None)], "id int, stage string, flagged_for_review boolean, llm_topic string")
    assert [r.id for r in models.pending(df).collect()] == [1, 2] and [r.id for r in models.unflagged(df).collect()] == [1, 3] and [r.id for r in models.enriched(df).collect()] == [1]
    assert models.missing_models(["a", "b", "a", "c"], ["b"]) == ["a", "c"]
    r = spark.createDataFrame([(0.5,), (None,), (0.9,)], "c double").select(models.review_reason(F.col("c")).alias("r")).collect()
    assert [x.r for x in r] == ["Low confidence: 0.50", "Low confidence: 0.00", ""]
    old = spark.createDataFrame([("", "n"), ("o", "n"), (None, "n")], "o string, n string").select(models.fill_missing(F.col("o"), F.col("n")).alias("r")).collect()
    assert [x.r for x in old] == ["n", "o", "n"] and "sop" in models.declared_contexts()


def test_asking_with_examples(spark):
    samples = spark.createDataFrame([("s", "noise(@P)", "sop", "noise", ["noise"], "")], "id string, code string, context string, topic string, calls array<string>, prompt string")
    questions = spark.createDataFrame([("q", "noise please"), ("r", "other thing")], "question_id string, question string")

    def answer(prompt):
        if prompt.startswith("other"):
            raise OSError("down")
        return f"{len(prompt.splitlines())} lines"

    got = {r.question_id: (r.prompt, r.answer) for r in enrich.ask(questions, samples, answer).collect()}
    assert "--- Example 1 (sop context, noise) ---\n```\nnoise(@P)\n```" in got["q"][0] and got["q"][1].endswith("lines")
    assert got["r"] == ("other thing", "Error: down")
    assert enrich.ask(questions, samples, answer, use_corpus=False).where("prompt like '%Example%'").count() == 0


def test_configuration(spark, tmp_path):
    config = {"models": {"tier1": {"primary": "a", "fallbacks": ["b"]}, "embedding": {"primary": "e"}}, "tasks": {"classify_topic": {"consensus": True}, "paraphrase": {}}}
    (tmp_path / "m.json").write_text(json.dumps(config))
    assert enrich.load_config(str(tmp_path / "m.json")) == config and enrich.load_config(str(tmp_path / "none.yaml")) == {}
    assert [tuple(r) for r in enrich.model_table(spark, config).collect()] == [(1, "a", ["b"])] and enrich.voted_tasks(config) == ["classify_topic"]
    yaml = pytest.importorskip("yaml")
    (tmp_path / "m.yaml").write_text(yaml.safe_dump(config))
    assert enrich.load_config(str(tmp_path / "m.yaml")) == config


def test_import_and_extract(spark):
    raw = spark.createDataFrame([(1, "", "@P = @N;", "beginner", ["f"]), (2, "x", "@P = @N;", "advanced", None), (3, "y", "  ", None, []), (4, "z", "a\nb\nc", "odd", ["a", "b", "c"])], "ord int, id string, code string, difficulty string, vex_functions array<string>")
    got = {r.code: (r.difficulty, r.attributes_read, r.attributes_written, r.complexity) for r in records.import_records(raw).collect()}
    assert got == {"@P = @N;": (1, ["N"], ["P"], "simple"), "a\nb\nc": (3, [], [], "moderate")}
    full = spark.createDataFrame([(5, "  f@a = chf('x') + chramp('y');  ", ["@P", "noise"], "wave", "cat", True, None, "s.txt", 0.5), (6, "f@a = chf('x') + chramp('y');", None, None, None, None, None, None, None)], "ord int, code string, vex_functions array<string>, topic string, category string, needs_review boolean, youtube_url string, source string, ocr_confidence double")
    (one,) = records.import_records(full).collect()
    assert one.code == "f@a = chf('x') + chramp('y');" and one.id == f"vex_{one.hash}" and one.channels == ["chf(", "chramp("] and one.functions == ["noise"]
    assert (one.topic, one.prompt, one.context, one.context_confidence, one.source_file, one.flagged_for_review, one.explanation, one.alternative_prompts) == ("cat", "wave", "SOP", 0.5, "s.txt", True, "", [])
    chunks = spark.createDataFrame([(["z"], ["w"], "noise(1)"), (None, None, "if(1) x")], "functions_referenced array<string>, validation_warnings array<string>, code string")
    assert [r.functions_referenced for r in records.extract(chunks, F.col("code")).collect()] == [["noise", "z"], []]


def test_stages_apply_the_tasks_answers(spark, known):
    def model(name, task, text):
        if text == "broken" and task != "classify_wrangle":
            raise OSError("down")
        return json.dumps({"classify_wrangle": {"context": "sop", "confidence": 0.9 if text != "odd" else 0.5}, "extract_attributes": {"reads": ["P"], "writes": ["Cd"]}, "extract_functions": {"functions": ["noise"]}, "detect_bugs": {"bugs": [{"type": "t"}]},
                           "estimate_complexity": {"complexity": "O(1)"}, "classify_topic": {"primary_topic": "noise"}, "generate_prompt": {"prompt": "p", "alternative_phrasings": ["q"]}, "explain_code": {"explanation": "e"}, "rate_difficulty": {"difficulty": 4}}[task])

    samples = spark.createDataFrame([("a", "fine", "kept"), ("b", "odd", None), ("c", "broken", "kept")], "id string, code string, topic string")
    one = enrich.tier_one_stage(samples, known, model)
    got = {r.id: (r.context, r.context_confidence, r.attributes_read, r.channels, r.functions, r.complexity, r.topic, r.flagged_for_review, r.review_reason) for r in one.collect()}
    assert got == {"a": ("sop", 0.9, ["P"], [], ["noise"], "O(1)", "noise", False, ""), "b": ("sop", 0.5, ["P"], [], ["noise"], "O(1)", "noise", True, "Low context confidence: 0.50"), "c": ("sop", 0.9, None, None, None, None, "kept", False, "")}
    two = {r.id: (r.stage, r.prompt, r.alternative_prompts, r.explanation, r.difficulty) for r in enrich.tier_two_stage(one, known, model).collect()}
    assert two == {"a": ("complete", "p", ["q"], "e", "4"), "b": ("tier1", None, None, None, None), "c": ("complete", None, None, None, None)}


def test_answers_say_their_status(spark, known):
    answers = {"a": '{"status": "uncertain", "confidence": 0.4, "result": {"x": 1}}', "b": '{"status": "odd", "x": 2}', "c": "[1]", "d": '{"confidence": "high"}'}
    tasks = spark.createDataFrame([(k, "classify_topic", k) for k in answers], "task_id string, task string, input string")
    got = {r.task_id: (r.status, r.result, r.confidence) for r in models.call_models(models.route(tasks, known), lambda name, task, text: answers[text]).collect()}
    assert got == {"a": ("uncertain", '{"x": 1}', 0.4), "b": ("success", '{"status": "odd", "x": 2}', 0.0), "c": ("error", None, 0.0), "d": ("success", '{"confidence": "high"}', 0.0)}


def test_repair(spark):
    cols = "id string, content string, llm_topic string, llm_secondary_topics array<string>, llm_bugs array<struct<type:string,description:string>>, llm_code_quality string, llm_complexity string, llm_bottlenecks array<string>, code string"
    rows = [("a", "", "Point Cloud Operations", ["Edge Topology, x", "a b"], [("resource_leak", "")], "minor_issues", None, None, "x = noise(@P) + snoise(1);"), ("b", "c", "point_cloud_ops", None, None, None, "O(1)", ["l"], "pgfind(0) + 1;"), ("c", "c", "", None, None, None, None, None, "")]
    got = {r.id: (r.content, r.llm_topic, r.llm_secondary_topics, [x.type for x in r.llm_bugs] if r.llm_bugs is not None else None, r.llm_code_quality, r.llm_complexity, r.llm_bottlenecks) for r in records.repair(spark.createDataFrame(rows, cols), F.col("code")).collect()}
    assert got == {"a": ("x = noise(@P) + snoise(1);", "noise_patterns", ["edge_topology", "a_b"], [], "clean", "unknown", []), "b": ("c", "point_cloud_ops", None, [], "unknown", "O(1)", ["l"]), "c": ("c", "", None, None, None, None, None)}
