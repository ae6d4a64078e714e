import pytest
from pyspark.sql import functions as F

from lodestone.functions import code as C
from lodestone.functions import identity
from lodestone.functions import text as T


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(("code", "digest"), [('@P += @N * ch("amplitude");', "cdd9d0272bac45a9"), ('int h = pcopen(0, "P", @P, 1.0, 10); pcclose(h);', "83659f3d62e3234c")])
def test_hash16(spark, code, digest):
    assert one(spark, identity.hash16(F.col("c")), c=code) == digest


def test_calls(spark):
    assert one(spark, C.calls(F.col("c")), c="a(b(1)); @P.x(2) #f(3) if(4) Vector(5) Zed(6)") == ["a", "b", "vector"]


def test_attributes(spark):
    a = C.attributes(F.col("c"))
    code = '@Cd = @N; @P += 1; @a == 2; ch("x"); chf("y")'
    assert one(spark, a["written"], c=code) == ["Cd", "a"]
    assert one(spark, a["read"], c=code) == ["N", "P"]
    assert one(spark, a["channels"], c=code) == ["y"]


def test_warnings(spark):
    got = one(spark, C.warnings(F.col("c")), c="a = 1\nb = 2;\nif (x) {\npcopen(1);\n@ptnum = 3;")
    assert got == ["Line 1: possible missing semicolon: a = 1", "Unclosed braces: 1 more { than }", "pcopen() called without pcclose() -- potential resource leak", "Assigning to @ptnum -- this is a read-only attribute"]


def test_text(spark):
    assert one(spark, T.first_sentence(F.col("t")), t="One two... Three. Four") == "One two."
    assert one(spark, T.first_sentence(F.col("t")), t="x" * 300) == "x" * 197 + "...."
    assert one(spark, T.truncate_lines(F.col("t"), 2), t="a\nb\nc\n\n") == "a\nb\n// ..."
    assert one(spark, T.pretty_label(F.col("t")), t="it's a-b_noise2d x") == "It'S A-B Noise2D X"
    assert one(spark, T.shingles(F.col("w")), w=["a", "b"]) == ["a", "b"]
    assert one(spark, T.shingles(F.col("w")), w=["a", "b", "c", "d"]) == ["a b c", "b c d", "a", "b", "c", "d"]
    assert one(spark, T.search_tokens(F.col("t")), t="The @É élan x @y a_1") == ["the", "@é", "élan", "@y", "a_1"]


def test_topics_and_levels(spark):
    assert one(spark, C.normal_topic(F.col("t")), t="Edge Topology, Other") == "edge_topology"
    assert one(spark, C.difficulty_of_word(F.col("t")), t=" Very Hard ") == "expert"
    assert one(spark, C.snippet_context(F.col("t")), t="setprimattrib(0)") == "prim"
    assert one(spark, C.contexts(F.col("t")), t="@Frame + @P") == ["dop", "sop"]
    assert one(spark, C.version(F.col("t"))[0], t="chramp(1); dict d;") == "18.0"


def test_words_of_models_and_answers(spark):
    from lodestone.functions import packs as P
    from lodestone.operators import models

    word, kind = next(iter(P.COMPLEXITY_WORDS.items()))
    df = spark.createDataFrame([(f" {word.upper()} ", '```json\n{"a": 1}\n```'), ("own word", "no json")], "w string, a string")
    got = df.select(C.complexity_of_word(F.col("w")).alias("w"), F.to_json(models.parse_answer(F.col("a"))).alias("a")).collect()
    assert [(r.w, r.a) for r in got] == [(kind, '{"a":1}'), ("own word", None)]
