import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import search, vectors

from .conftest import SF


def rows(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 4)) for r in df.collect())


def clustered(spark, n=3000, dims=16):
    r = np.random.default_rng(7)
    middles = r.normal(size=(30, dims))
    v = middles[r.integers(0, 30, n)] + 0.15 * r.normal(size=(n, dims))
    v[: n // 3] = v[0]  # a third of all rows are one vector
    data = [(i, x.tolist()) for i, x in enumerate(v)] + [(n, None), (n + 1, [0.0] * dims), (n + 2, [float("nan")] * dims), (n + 3, [float("inf")] * dims), (n + 4, [None] * dims), (n + 5, []), (n + 6, v[5].tolist()), (n + 6, v[5].tolist())]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("most", [1 << 26, 4096])
def test_the_index_finds_what_a_scan_finds_and_reads_less(spark, tmp_path, most):
    v = clustered(spark).withColumn("cell", F.lit("x")).withColumn("block", F.lit(1))
    index = vectors.build_vectors(v, "vec_id", "embedding", str(tmp_path / "i"), 40, 6)
    sound = v.where("embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    assert index.rows.count() == sound.count() == 3003 and index.blocks.agg(F.max("n")).first()[0] <= 64
    asked = v.where("vec_id % 50 = 0 or vec_id > 2995")
    got, read = vectors.search_vectors(index, asked, "vec_id", "embedding", 9, 5, most)
    want = search.dense(sound, "vec_id", "embedding", sound.where("vec_id % 50 = 0 or vec_id > 2995").dropDuplicates(["vec_id"]), "vec_id", "embedding", 9, 5)
    # queries of one id twice are not asked for
    keep = F.col("query_id") != 3006
    assert rows(got.where(keep)) == rows(want.where(keep)) and got.count() > 500
    share = read.where("query_id > 1000 and query_id < 3000").agg(F.sum("read") / F.sum("n")).first()[0]
    assert share < 0.2
    zero = read.where("query_id = 3001").first()
    assert zero.read == zero.n == 3003


def test_vectors_without_clusters_are_found_too(spark, tmp_path):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    vectors.build_vectors(v, "vec_id", "embedding", str(tmp_path / "i"))
    index = vectors.open_vectors(spark, str(tmp_path / "i"))
    asked = v.where("vec_id % 50 = 0")
    assert rows(vectors.search_vectors(index, asked, "vec_id", "embedding", 7, 5)[0]) == rows(search.dense(v, "vec_id", "embedding", asked, "vec_id", "embedding", 7, 5))
    assert vectors.search_vectors(index, asked.limit(0), "vec_id", "embedding")[0].count() == 0


def test_empty_tables_and_zero_vectors(spark, tmp_path):
    none = spark.createDataFrame([], "i string, v array<float>")
    asked = spark.createDataFrame([("q", [1.0, 0.0]), ("z", [0.0, 0.0])], "q string, v array<double>")
    index = vectors.build_vectors(none, "i", "v", str(tmp_path / "none"))
    assert vectors.search_vectors(index, asked, "q", "v")[0].count() == 0
    zeros = spark.createDataFrame([("b", [0.0, 0.0]), ("a", [0.0, 0.0]), (None, [0.0, 0.0])], "i string, v array<float>")
    index = vectors.build_vectors(zeros, "i", "v", str(tmp_path / "zeros"))
    got = vectors.search_vectors(index, asked, "q", "v", 2)[0].collect()
    assert {(r.query_id, r["rank"], r.id, r.score) for r in got} == {(q, n, i, 0.0) for q in "qz" for n, i in ((1, None), (2, "a"))}
    one = vectors.build_vectors(zeros.unionByName(spark.createDataFrame([("c", [-1.0, 0.0])], "i string, v array<float>")), "i", "v", str(tmp_path / "one"))
    got = vectors.search_vectors(one, asked.where("q = 'q'"), "q", "v", 9)[0].orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [(None, 0.0), ("a", 0.0), ("b", 0.0), ("c", -1.0)]
