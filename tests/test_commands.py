import json

import pytest

from lodestone.__main__ import main
from lodestone.operators import export


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rows = []
    for i in range(24):
        body = f"Text number {i} about noise and random pattern of points, " + " ".join(f"w{i % 12}_{k}" for k in range(30))
        rows.append({"id": f"joy_of_vex_ep{i + 1:02d}_1", "content": body, "code_blocks": [{"code": "float a = noise(@P);"}], "llm_topic": "noise_patterns" if i < 15 else "edge_topology", "difficulty": "", "source_id": "s", "source_authority": 0.5, "title": f"T{i}", "checksum": f"k{i % 20}", "functions_referenced": ["noise"]})
    path = folder / "corpus.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    return path


def lines(folder):
    return [json.loads(x) for p in sorted(folder.glob("*.json")) for x in p.read_text().splitlines()]


def test_merge_and_report(spark, corpus, tmp_path):
    main(["merge", "--input", f"{corpus},{corpus}", "--output", str(tmp_path / "m"), "--threshold", "0.6"], spark)
    assert len(lines(tmp_path / "m" / "merged")) == 20 and json.loads((tmp_path / "m" / "manifest.json").read_text())["dedup_pairs"] == 8
    main(["dedup-report", "--input", str(corpus), "--output", str(tmp_path / "r"), "--threshold", "0.6"], spark)
    out = json.loads((tmp_path / "r" / "dedup_report.json").read_text())
    assert (out["pairs"], out["clusters"], out["indexed"]) == (12, 12, 24)


def test_enriching_steps(spark, corpus, tmp_path, capsys):
    main(["extract", "--input", str(corpus), "--output", str(tmp_path / "x")], spark)
    assert json.loads(capsys.readouterr().out.splitlines()[0])["chunks_with_functions"] == 24
    main(["tag", "--input", str(corpus), "--output", str(tmp_path / "t")], spark)
    assert len(lines(tmp_path / "t" / "corpus")) == 24 and lines(tmp_path / "t" / "tagging_log")
    main(["link", "--input", str(corpus), "--output", str(tmp_path / "l")], spark)
    linked = {r["id"]: r["prerequisites"] for r in lines(tmp_path / "l" / "corpus")}
    assert linked["joy_of_vex_ep03_1"] == ["joy_of_vex_ep01_1", "joy_of_vex_ep02_1"]
    main(["repair", "--input", str(corpus), "--output", str(tmp_path / "c")], spark)
    assert json.loads((tmp_path / "c" / "stats.json").read_text())["llm_coverage"]["llm_topic"] == 24


def test_index_and_sync(spark, corpus, tmp_path, capsys):
    main(["index", "--input", str(corpus), "--output", str(tmp_path / "i")], spark)
    main(["search", "--input", str(tmp_path / "i"), "--query", "w3_1 noise", "--limit", "2"], spark)
    assert "joy_of_vex_ep04_1" in capsys.readouterr().out
    main(["sync", "--input", str(corpus), "--output", str(tmp_path / "s"), "--dry-run"], spark)
    assert not (tmp_path / "s").exists()
    main(["sync", "--input", str(corpus), "--output", str(tmp_path / "s")], spark)
    assert {p.name for p in (tmp_path / "s").glob("*.md")} == {"corpus_noise_patterns.md", "corpus_misc.md"}
    assert "## Edge Topology (9 examples)" in (tmp_path / "s" / "corpus_misc.md").read_text()
    assert export.MIN_TOPIC == 10


def answered(tier, code):
    return json.dumps({"topic": {"primary": "patterns"}, "bugs": [], "complexity": "low"} if tier == 1 else {"prompt": "make it", "explanation": "it is made", "key_concepts": ["noise"]})


def embedded(texts):
    return [[float(t.count("w3_")), float(t.count("w4_")), 1.0] for t in texts]


def test_import_and_enrich(spark, tmp_path, capsys):
    raw = [{"code": " @P = @N; ", "difficulty": "beginner", "topic": "t"}, {"code": "@P = @N;", "needs_review": True}, {"code": "  "}, {"id": "x", "code": "f@a = 1;", "difficulty": "advanced", "needs_review": True}]
    (tmp_path / "raw.jsonl").write_text("\n".join(map(json.dumps, raw)))
    for more in (["--dry-run"], []):
        main(["import", "--input", str(tmp_path / "raw.jsonl"), "--output", str(tmp_path / "imported"), *more], spark)
        told = json.loads(capsys.readouterr().out.splitlines()[0])
        assert told == {"records": 4, "converted": 3, "skipped": 1, "samples": 2, "difficulty:1": 1, "difficulty:5": 1, "all:flagged_for_review": 1}
        assert (tmp_path / "imported").exists() == (not more)
    assert {r["id"]: (r["code"], r["prompt"], r["flagged_for_review"]) for r in lines(tmp_path / "imported")} == {"x": ("f@a = 1;", "", True), next(r["id"] for r in lines(tmp_path / "imported") if r["id"] != "x"): ("@P = @N;", "t", False)}
    chunks = [{"id": f"c{k}", "content": "c", "code": "float a = noise(@P) * 2;\n@Cd = a;"} for k in range(5)] + [{"id": "none", "content": "no code"}]
    (tmp_path / "chunks.jsonl").write_text("\n".join(map(json.dumps, chunks)))
    asked = ["enrich", "--input", str(tmp_path / "chunks.jsonl"), "--output", str(tmp_path / "e"), "--model", "tests.test_commands:answered", "--limit", "3", "--concurrency", "4"]
    main([*asked, "--dry-run"], spark)
    assert json.loads(capsys.readouterr().out.splitlines()[0]) == {"tier1": {"lacking": 5}, "tier2": {"lacking": 5}} and not (tmp_path / "e").exists()
    main(asked, spark)
    assert json.loads(capsys.readouterr().out.splitlines()[0]) == {"tier1": {"lacking": 5, "enriched": 3}, "tier2": {"lacking": 5, "enriched": 3}}
    got = lines(tmp_path / "e" / "corpus")
    assert len(got) == 6 and sum(r.get("llm_topic") == "patterns" for r in got) == 3 and sum(r.get("prompt") == "make it" for r in got) == 3


def test_hybrid_search_and_evaluation(spark, corpus, tmp_path, capsys):
    hook = ["--embedder", "tests.test_commands:embedded"]
    main(["index", "--input", str(corpus), "--output", str(tmp_path / "i"), *hook], spark)
    main(["search", "--input", str(tmp_path / "i"), "--query", "w3_1 noise", "--limit", "2", *hook], spark)
    assert {"joy_of_vex_ep04_1", "joy_of_vex_ep16_1"} == {w for w in capsys.readouterr().out.replace("|", " ").split() if w.startswith("joy_")}
    (tmp_path / "q.jsonl").write_text("\n".join(map(json.dumps, [{"id": "q1", "query": "w3_1 w3_2", "relevant_patterns": ["w3_1", "w3_2"], "required_functions": ["noise"]}, {"id": "q2", "query": "w4_1", "relevant_patterns": ["absent", "missing"]}])))
    for more in ([], hook):
        out = tmp_path / f"out{len(more)}"
        main(["evaluate", "--input", str(corpus), "--index", str(tmp_path / "i"), "--questions", str(tmp_path / "q.jsonl"), "--output", str(out), "--limit", "5", *more], spark)
        per = {r["query_id"]: r for r in lines(out / "per_query")}
        assert (per["q1"]["relevant"], per["q1"]["recall"], per["q1"]["mrr"], per["q1"]["has_required"], per["q1"]["returned"]) == (2, 1.0, 1.0, True, 5 if more else 2)
        assert per["q2"]["verdict"] == "FAIL" and json.loads(capsys.readouterr().out.splitlines()[0])["pass_rate"] == lines(out / "summary")[0]["pass_rate"]


def test_sources(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.vex").write_text("@P = 1;")
    (tmp_path / "in" / "g.md").write_text("# One\ntext\n")
    (tmp_path / "in" / "JoyOfVex03.html").write_text("<h2>A</h2><p>words of it</p>")
    for step, n in (("ingest", 1), ("markdown", 1), ("wiki", 1), ("reference", 1)):
        main([step, "--input", str(tmp_path / "in"), "--output", str(tmp_path / step), "--dry-run"], spark)
        assert not (tmp_path / step).exists()
        main([step, "--input", str(tmp_path / "in"), "--output", str(tmp_path / step)], spark)
        found = len(lines(tmp_path / step))
        assert found == n if step != "reference" else found <= n
    (tmp_path / "old.jsonl").write_text(json.dumps({"id": "x", "code": "1", "difficulty": 6, "generation": {"explanation": "e"}}))
    main(["migrate", "--input", str(tmp_path / "old.jsonl"), "--output", str(tmp_path / "new")], spark)
    assert lines(tmp_path / "new")[0]["difficulty"] == "advanced"
