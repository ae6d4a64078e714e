import json

from pyspark.sql import functions as F

from lodestone.functions import code as C
from lodestone.functions import text as T
from lodestone.sources import files, html

GUIDE = """intro `x`
```vex
@P = 1;
```
prose
```
no mark
```
```cpp
float a = 1;
```
again
```vex
@P = 1;
```
"""


def test_fences_know_their_lines(spark, tmp_path):
    (tmp_path / "guide.md").write_text(GUIDE)
    (tmp_path / "none.txt").write_text("no fence")
    got = files.fence_samples(files.whole_files(spark, str(tmp_path), files.TEXT_SUFFIXES)).orderBy("source_line").collect()
    lines = GUIDE.split("\n")
    assert [(r.source_line, r.code) for r in got if r.code == "@P = 1;"] == [(2, "@P = 1;"), (13, "@P = 1;")]  # two equal blocks, each with its own line
    assert all(lines[r.source_line - 1].endswith(("```vex", "```cpp", "```")) for r in got)
    anchored = files.fence_samples(files.whole_files(spark, str(tmp_path), ("md",)), anchored=True).collect()
    assert [r.source_line for r in anchored if r.code.startswith("float")] == [9]


def test_json_trees(spark, tmp_path):
    tree = {"id": "a", "code": " @P = 1; ", "deep": [{"snippet": "int x;", "id": 7, "vex": {"code": "@N"}}, {"code": "nothing here"}], "vex_code": 5}
    rows = spark.createDataFrame([(1, json.dumps(tree)), (2, "{broken"), (3, None), (4, "[" * 3000 + "]" * 3000)], "k int, j string")
    got = files.json_strings(rows, "j").orderBy("k", "place").collect()
    assert [(r.k, r.id, r.key, r.value) for r in got] == [(1, "a", "code", " @P = 1; "), (1, "7", "snippet", "int x;"), (1, "", "code", "@N"), (1, "", "code", "nothing here")]
    (tmp_path / "t.json").write_text(json.dumps(tree))
    (tmp_path / "bad.json").write_text("{")
    assert [(r.id, r.code) for r in files.json_samples(spark, str(tmp_path)).orderBy("place").collect()] == [("a", "@P = 1;"), ("7", "int x;"), ("", "@N")]


def test_ingest_takes_all_kinds_once(spark, tmp_path):
    (tmp_path / "a.vex").write_text("@P = 1;")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.md").write_text("```\n@P = 1;\n```\n```vex\n@N = 2;\n```")
    (tmp_path / "c.json").write_text(json.dumps([{"id": "own", "code": "@Cd = 3;"}]))
    (tmp_path / "d.hip").write_text("@P = 4;")
    got = {r.code: r.id for r in files.ingest(spark, str(tmp_path)).collect()}
    assert got.keys() == {"@P = 1;", "@N = 2;", "@Cd = 3;"} and got["@Cd = 3;"] == "own" and got["@P = 1;"].startswith("vex_")


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{bad\n{"a": "z"}\n')
    assert files.json_lines(spark, str(tmp_path / "x.jsonl")).count() == 2
    assert [r.a for r in files.typed_json_lines(spark, str(tmp_path / "x.jsonl"), "a string").where("a is not null").orderBy("a").collect()] == ["1", "z"]
    assert files.literal(spark, " x ", "here").first().code == " x "
    got = files.json_values(spark.createDataFrame([('{"k": 3}',), ("{",), ('{"k": "x"}',)], "p string"), "p", {"k": "bigint"})
    assert [r.k for r in got.collect()] == [3, None, None]


def test_navigation_needs_its_colon_beside_it():
    assert html.sections("<h1>T</h1><p>This node has two inputs: a and b</p>") == [("T", "This node has two inputs: a and b", [])]
    assert html.sections("<h1>T</h1><p> Prev : one, next: two</p>") == []
    assert html.sections("<p>next: " + "x" * 200 + "</p>")[0][1].startswith("next: x")


def test_sections_of_a_fragment():
    page = """lead <h2>One<a> ¶</a></h2><p>a <b>bold</b> word</p><div class="language-vex x"><span>vex</span><pre><code>@P = 1;
int a;</code></pre></div><ul><li>item <pre>float b;</pre> end</li></ul>
<p>inline <code>one</code> and <code>vector v;
v += 1;</code></p><h3>Two</h3><blockquote>this: nav</blockquote><h4>Three</h4><pre> </pre>tail"""
    assert html.sections(page, "Top") == [
        ("Top", "lead", []),
        ("One ¶", "a bold word\n\nitem end\n\ninline one and", ["@P = 1;\nint a;", "float b;", "vector v;\nv += 1;"]),
        ("Three", "tail", []),
    ]


def test_whole_pages_are_entered_to_their_headings():
    assert html.sections("<html><head><title>t</title></head><body><nav>n</nav><article><h1>H</h1><p>x<br>y</p></article></body></html>") == [("", "n", []), ("H", "x y", [])]
    deep = "<div>" * 5000 + "<h1>H</h1>z" + "</div>" * 5000
    assert len(html.sections("<p>x</p>" + "<b>" * 3000 + "y")) == 1 and deep


def test_wiki_chunks(spark):
    pages = spark.createDataFrame([("JoyOfVex07", "lead<h2>A</h2><p>x</p>"), ("HoudiniVex", "<p>y</p>"), ("JoyOfVex20", "<p>z</p>"), ("Other", "")], "name string, html string")
    got = {r.id: (r.title, r.section, r.difficulty, r.content) for r in html.wiki_chunks(pages).collect()}
    assert got == {
        "wiki_joyofvex07_001": ("Joy of VEX Day 7", "Joy of VEX Day 7", "intermediate", "lead"),
        "wiki_joyofvex07_002": ("A", "Joy of VEX Day 7", "intermediate", "x"),
        "wiki_houdinivex_001": ("HoudiniVex Tips", "HoudiniVex Tips", "intermediate", "y"),
        "wiki_joyofvex20_001": ("Joy of VEX Day 20", "Joy of VEX Day 20", "advanced", "z"),
    }


REFERENCE = """<body><h1>dot</h1><pre class="signature">float dot(vector a, vector b)</pre><div class="content"><p>short</p><p>Gives the dot product of both.</p><p>Second paragraph of it.</p></div>
<dl><dt>a</dt><dd>the first vector</dd><dt>b</dt><dd>the second</dd></dl><pre>float d = dot({1,0,0}, {0,1,0});</pre><pre>dot(a,b)</pre><div>See also <a href="cross">cross</a> <a href="dot">dot</a></div></body>"""


def test_reference_pages(spark, tmp_path):
    (tmp_path / "dot.html").write_text(REFERENCE)
    (tmp_path / "index.html").write_text("<p>no function</p>")
    (tmp_path / "empty.html").write_text("<p></p>")
    r = html.reference_chunks(html.saved_pages(spark, str(tmp_path)), category=F.lit("Shading functions")).collect()
    assert len(r) == 1 and r[0].id == "reference_ref_dot" and r[0].vex_context == ["material"]
    assert r[0].content == "Signature: float dot(vector a, vector b)\n\nReturns: float\n\nGives the dot product of both.\n\nSecond paragraph of it.\n\nParameters:\n  - a: the first vector\n  - b: the second\n\nRelated: cross"
    assert [(b.code, b.line_context) for b in r[0].code_blocks] == [("float dot(vector a, vector b)", "signature"), ("float d = dot({1,0,0}, {0,1,0});", "example")]
    assert r[0].functions_referenced == ["dot", "cross"]


def test_function_index(spark):
    page = "<h2>Math</h2><dl><dt><a href='abs'>abs</a></dt><dd>absolute value</dd></dl><a href='#x'>here</a><a href='http://z'>far</a><h3>Noise</h3><a href='noise.html'>noise</a>"
    got = html.function_index(spark.createDataFrame([(1, page)], "page_id int, html string"), base_url="u").orderBy("seq").collect()
    assert [(r.name, r.url, r.category, r.brief) for r in got] == [("abs", "u/abs.html", "math", "absolute value"), ("abs", "u/abs.html", "math", ""), ("noise", "u/noise.html", "noise", "")]


def test_page_modules(spark):
    module = "import{a as e}from'x';const o=e('<h1>It\\'s</h1><p>x</p>',2),p=[o];"
    tail = "const o=e('<h2>A</h2>',12)"
    page = '<script>window.__VP_HASH_MAP__=JSON.parse("{\\"a.md\\":\\"x1\\"}")</script><link rel="modulepreload" crossorigin href="/site/assets/app.js">'
    df = spark.createDataFrame([(module, tail, "nothing", page)], "a string, b string, c string, d string")
    r = df.select(html.carved_body(F.col("a")).alias("a"), html.carved_body(F.col("b")).alias("b"), html.carved_body(F.col("c")).alias("c"), html.hash_map(F.col("d")).alias("m"), html.asset_prefix(F.col("d")).alias("p")).first()
    assert (r.a, r.b, r.c, r.m, r.p) == ("<h1>It's</h1><p>x</p>", "<h2>A</h2>", None, {"a.md": "x1"}, "/site/assets/")


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first().r


def test_known_calls_count_in_any_case(spark):
    code = "Normalize(v); Length(x); Dot(a,b); Solver(1); Luminance(c); Abs(1); myfunc(2); If(x); Vector(1) @a.b(2)"
    assert one(spark, C.calls(F.col("c")), c=code) == ["Abs", "Dot", "Length", "Normalize", "myfunc", "vector"]


def test_texts_of_records(spark):
    assert one(spark, C.joined_code("\n\n", F.col("b"), F.col("c"), stripped=True), b=[" a", "b"], c="c ") == "a\n\nb\n\nc"
    assert one(spark, C.joined_code(" ", F.col("b"), F.col("c")), b=["a", None], c="") == "a "
    assert one(spark, T.searchable(F.col("t"), F.col("x"), F.col("b"), F.col("c"), F.col("p"), F.col("e")), t="T", x="", b=["a", ""], c=None, p="p", e="") == "T\na\np"
    assert one(spark, T.comparable(F.col("x"), F.col("b")), x="A b", b=["C", "D"]) == "a b c d"
    assert one(spark, T.episode(F.col("x")), x="joy_of_vex_ep07_3") == 7 and one(spark, T.episode(F.col("x")), x="none") is None
    assert one(spark, T.clean_heading(F.col("x")), x="Head¶​ ") == "Head"
    assert one(spark, T.unfence(F.col("x")), x='a ```json\n{"b": 1}\n``` c') == '{"b": 1}' and one(spark, T.unfence(F.col("x")), x="```\nz```") == "z"
    assert one(spark, T.sequence_id(F.lit("p"), F.col("x").cast("int")), x="7") == "p_007"
    assert one(spark, C.is_snippet(F.col("c"), F.col("l")), c="vector a;", l="C++") is True and one(spark, C.is_snippet(F.col("c"), F.col("l")), c="vector a;", l="python") is False
    assert one(spark, C.local_contexts(F.col("c")), c="@Frame + @voxelsize + @uv") == ["dop", "material"]


def test_pages_through_table_functions_in_sql(spark):
    page = '<body><h1>T</h1><p>a <code>b</code></p><div><h2>U</h2><pre>int x;\nint y;</pre><p>more</p></div><a href="/n">next</a> <a href="/e"> </a></body>'
    spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string").createOrReplaceTempView("own_pages")
    html.register(spark)
    got = spark.sql("SELECT page_id, s.* FROM own_pages, LATERAL page_sections(html) s ORDER BY page_id, seq").collect()
    assert [tuple(r) for r in got] == [(1, 1, "T", "a b", []), (1, 2, "U", "more\n\nnext", ["int x;\nint y;"])]
    assert [tuple(r) for r in spark.sql("SELECT page_id, a.* FROM own_pages, LATERAL page_anchors(html) a").collect()] == [(1, "/n", "next")]
    assert [(r.page_id, r.seq, r.heading) for r in html.page_chunks(spark.table("own_pages")).orderBy("seq").collect()] == [(1, 1, "T"), (1, 2, "U")]


def test_deep_and_broken_pages_in_linear_time():
    import time

    n = 20_000
    deep = "<div>" * n + "<h2>H</h2><p>text</p>" + "</b></div>" * n
    wide = "<dl>" + "".join(f"<dt><a href='f{k}'>f{k}</a></dt><dd>does {k}</dd>" for k in range(n)) + "</dl>"
    many = "<p>" + "<pre>int x;</pre>" * 2000 + "</p>"
    began = time.process_time()
    assert html.sections(deep) == [("H", "text", [])]
    assert time.process_time() - began < 2
    began = time.process_time()
    rows = html._index(wide)
    assert len(rows) == 2 * n and rows[0] == ("f0", "f0.html", "", "does 0") and rows[-2][3] == f"does {n - 1}"
    assert len(html.sections(many)[0][2]) == 2000 and time.process_time() - began < 3


def test_index_rows_meet_their_pages(spark):
    index = "<h2>Noise</h2><a href='noise'>noise</a><dl><dt><a href='noise'>noise</a></dt><dd>Makes noise.</dd><dt><a href='gone'>gone</a></dt><dd>No page.</dd></dl>"
    rows = html.function_index(spark.createDataFrame([(1, index)], "page_id long, html string"), base_url="http://x")
    pages = spark.createDataFrame([("noise", "<body><p>Noise of a point.</p><pre>float noise(vector p)</pre></body>"), ("other", "<p>Not in the index.</p>")], "name string, html string")
    found = html.indexed_pages(rows, pages)
    assert [(r.name, r.url, r.category, r.brief) for r in found.collect()] == [("noise", "http://x/noise.html", "noise", "Makes noise.")]
    got = html.reference_pages(found, category=F.col("category")).first()
    assert got.name == "noise" and got.signature == "float noise(vector p)" and got.description == "Noise of a point."
