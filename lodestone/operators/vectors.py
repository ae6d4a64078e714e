"""A stored index of vectors for exact search by cosine: rows lie by their nearest centre, and cells and blocks are read only where their bounds can beat a query's k-th score.

Centres come from Spark's KMeans over a sample (SAMPLE rows, by hash, in expectation); every row is indexed. The index keeps each row's angle to its centre. For a query at angle a to the centre, a row at
angle r to it is at least |a - r| away from the query (the triangle inequality of angles), so a cell or block with angles from low to high cannot come nearer than max(0, a - high, low - a).
Centres decide only how much is read, never what is found.

Rows with a null vector, or one that is empty or holds null or non-finite components, take no part, nor do such queries. Vectors are of one length. Zero vectors score 0 and lie in a cell of their own.
Rows of the same id stay separate rows; null ids are ids. An empty table gives an index that answers nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import shared_folder
from .search import AT_ONCE, QUERY_BYTES, _met, _unit, top

SAMPLE = 50_000  # rows that centres are fitted on
MOST_CENTRES = 4096
CENTRE_BYTES = 64 << 20  # centres are sent to every task
BLOCK_BITS = 12  # a block has at most 2^12 rows
ALL = 4.0  # beyond every angle
SLACK = 1e-6  # of angles, over what arccos loses near 1
ZERO = -1  # the cell of zero vectors


@dataclass(frozen=True)
class VectorIndex:
    rows: DataFrame  # block, angle, id, v, cell (the folders)
    blocks: DataFrame  # cell, block, low, high, n
    centres: DataFrame  # cell, centre


def _sound(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _centres(rows: DataFrame, n: int, k: int | None) -> np.ndarray:
    """Unit vectors, one a row; none if no row has a direction."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    some = rows.where(F.exists("v", lambda x: x != 0))
    size = some.select(F.size("v").alias("n")).first()
    if size is None:
        return np.zeros((0, 0))
    k = max(1, min(k or round(n**0.5), MOST_CENTRES, CENTRE_BYTES // (8 * size.n)))
    grains = 1 << 30
    least = grains if n <= SAMPLE else grains * SAMPLE // n
    sample = some.where(F.pmod(F.xxhash64("id", "v"), F.lit(grains)) < least).select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
    if sample.first() is None:  # one text of all rows may miss the sample
        sample = some.limit(1).select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
    if k == 1 or sample.limit(2).count() < 2:
        return _unit([sample.first().features.toArray()])
    return _unit(KMeans(k=k, seed=42, maxIter=8, distanceMeasure="cosine").fit(sample).clusterCenters())


def build_vectors(vectors: DataFrame, id_col: str, vector_col: str, folder: str, centres: int | None = None, block_bits: int = BLOCK_BITS) -> VectorIndex:
    """Writes the index of vectors below a folder and opens it. centres: so many (none: the root of the number of rows), within MOST_CENTRES and CENTRE_BYTES."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(_sound(F.col("v")))
    middle = _centres(rows, rows.count(), centres)
    sent = spark.sparkContext.broadcast(middle)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), AT_ONCE):
                some = part.iloc[at : at + AT_ONCE]
                u = _unit(some["v"].tolist())
                zero = ~u.any(1)
                if len(sent.value):
                    dots = u @ sent.value.T
                    cell = dots.argmax(1)
                    angle = np.arccos(np.clip(dots[np.arange(len(u)), cell], -1, 1))
                else:
                    cell, angle = np.zeros(len(u), int), np.zeros(len(u))
                yield some.assign(cell=np.where(zero, ZERO, cell).astype("int32"), angle=np.where(zero, 0.0, angle))

    kinds = f"id {rows.schema['id'].dataType.simpleString()}, v {rows.schema['v'].dataType.simpleString()}, salt long, cell int, angle double"
    placed = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(1024))).mapInPandas(place, kinds)  # salt: repeated rows are dealt over ranges too
    order = ["cell", "angle", "id", "salt"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    placed.withColumn("block", F.shiftright(F.monotonically_increasing_id(), block_bits)).write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/rows")
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(middle)], "cell int, centre array<double>").write.mode("overwrite").parquet(f"{folder}/centres")
    stored = _rows(spark, folder, kinds)
    stored.groupBy("cell", "block").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).write.mode("overwrite").parquet(f"{folder}/blocks")
    rows.limit(0).write.mode("overwrite").parquet(f"{folder}/kinds")
    return open_vectors(spark, folder)


def _rows(spark: SparkSession, folder: str, kinds: str) -> DataFrame:
    """The rows, also of an index that has none."""
    return spark.read.schema(f"{kinds}, block long").parquet(f"{folder}/rows").select("cell", "block", "angle", "id", "v")


def open_vectors(spark: SparkSession, folder: str) -> VectorIndex:
    kind = spark.read.parquet(f"{folder}/kinds").schema
    kinds = f"id {kind['id'].dataType.simpleString()}, v {kind['v'].dataType.simpleString()}, angle double, cell int"
    return VectorIndex(_rows(spark, folder, kinds), *(spark.read.parquet(f"{folder}/{t}") for t in ("blocks", "centres")))


def _gaps(q: np.ndarray, middle: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least angle that any row of a cell can have to a query: queries by cells, the last cell being that of zero vectors."""
    a = np.arccos(np.clip(q @ middle.T, -1, 1)) if len(middle) else np.zeros((len(q), 0))
    a = np.hstack([a, np.full((len(q), 1), np.pi / 2)])
    return np.maximum(0.0, np.maximum(a - high, low - a))


def search_vectors(index: VectorIndex, queries: DataFrame, query_col: str, query_vector: str, k: int = 20, digits: int = 6, most_bytes: int = QUERY_BYTES) -> tuple[DataFrame, DataFrame]:
    """query_id, id, score, rank by cosine, as dense() gives them; and how far blocks are skipped: query_id, n (rows of the index), read.

    Each query (ids of queries are distinct) first meets the cells nearest to it that have k rows; the k-th score there is one that others must beat. Then it meets the cells, and of these the blocks, whose bound can.
    Queries of most_bytes at most are sent to the tasks that read the cells; more meet their blocks by a shuffle, in slices of that size.
    """
    spark = queries.sparkSession
    shared_folder(spark)
    cells = index.blocks.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()  # at most MOST_CENTRES + 1
    middle = np.array([r.centre for r in index.centres.orderBy("cell").collect()], float)
    low, high, held = (np.full(len(middle) + 1, fill) for fill in (ALL, -ALL, 0.0))
    for r in cells:
        low[r.cell], high[r.cell], held[r.cell] = r.low, r.high, r.n  # ZERO is the last
    asked = queries.select(F.col(query_col).alias("query_id"), F.col(query_vector).cast("array<double>").alias("q")).where(_sound(F.col("q"))).checkpoint()
    kind = asked.schema["query_id"].dataType.simpleString()
    found_kinds = f"query_id {kind}, id {index.rows.schema['id'].dataType.simpleString()}, score double"
    size = asked.agg(F.coalesce(F.sum(8 * F.size("q") + 8), F.lit(0))).first()[0]
    if not size or not cells:
        return spark.createDataFrame([], found_kinds + ", rank int"), asked.select("query_id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("read"))
    bounds = spark.sparkContext.broadcast((middle, low, high, held))

    def reached(first: bool):  # noqa: ANN202
        """query_id, cell, least angle t that counts: of the first cells, or of all within t."""

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            middle, low, high, held = bounds.value
            for part in parts:
                for at in range(0, len(part), AT_ONCE):
                    some = part.iloc[at : at + AT_ONCE]
                    q, t = _unit(some["q"].tolist()), some["t"].to_numpy()
                    gap = np.where(held > 0, _gaps(q, middle, low, high), 2 * ALL)
                    take = gap <= t[:, None]
                    if first:
                        near = gap.copy()
                        if len(middle):
                            near[:, :-1] += 1e-9 * (1 - q @ middle.T)  # many cells may hold a query; its own centre comes first
                        near = np.argsort(near, axis=1, kind="stable")
                        before = np.cumsum(held[near], axis=1) - held[near]
                        take = np.zeros_like(take)
                        np.put_along_axis(take, near, before < k, axis=1)
                        take &= held > 0
                    who, cell = np.nonzero(take)
                    cell = np.where(cell == len(middle), ZERO, cell).astype("int32")
                    yield pd.DataFrame({"query_id": some["query_id"].to_numpy()[who], "cell": cell, "t": t[who]})

        return run

    def scored(bounded: DataFrame, first: bool) -> tuple[DataFrame, DataFrame]:
        """query_id, id, score of candidates; query_id, cell, block, n of the blocks that are met. bounded: query_id, q, t."""
        pairs = bounded.mapInPandas(reached(first), f"query_id {kind}, cell int, t double").checkpoint()
        wanted = [r.cell for r in pairs.select("cell").distinct().collect()]  # at most MOST_CENTRES + 1
        rows = index.rows.where(F.col("cell").isin(wanted))

        @F.pandas_udf("double")
        def to_centre(cell: pd.Series, q: pd.Series) -> pd.Series:
            if not len(cell):
                return pd.Series([], dtype=float)
            u = _unit(q.tolist())
            middle = np.vstack([bounds.value[0].reshape(-1, u.shape[1]), np.zeros(u.shape[1])])  # ZERO is the last
            return pd.Series(np.arccos(np.clip((u * middle[cell.to_numpy()]).sum(1), -1, 1)))

        near = pairs.join(bounded.select("query_id", "q"), "query_id").withColumn("a", to_centre("cell", "q"))
        within = F.lit(True) if first else F.greatest(F.col("a") - F.col("high"), F.col("low") - F.col("a")) <= F.col("t")
        blocks = near.join(index.blocks, "cell").where(within).select("query_id", "q", "cell", "block", "n")
        if size <= most_bytes:
            got = bounded.collect()
            firsts: dict[int, list] = {}
            if first:
                at = {r.query_id: i for i, r in enumerate(got)}
                for r in pairs.collect():  # few cells a query: as many as hold k rows
                    firsts.setdefault(r.cell, []).append(at[r.query_id])
            sent = spark.sparkContext.broadcast(([r.query_id for r in got], _unit([r.q for r in got]), np.array([r.t for r in got]), firsts))

            def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                names, q, t, firsts = sent.value
                middle = bounds.value[0]
                for part in parts:
                    for cell, g in part.groupby("cell"):
                        if first:
                            pick = np.array(firsts.get(cell, []), int)
                        else:
                            a = np.full(len(q), np.pi / 2) if cell == ZERO else np.arccos(np.clip(q @ middle[cell], -1, 1))
                            pick = np.nonzero(np.maximum(a - g["angle"].max(), g["angle"].min() - a) <= t)[0]
                        if len(pick):
                            yield from _met([names[i] for i in pick], q[pick], g["id"].tolist(), _unit(g["v"].tolist()), k, digits)

            return rows.mapInPandas(run, found_kinds), blocks.drop("q")
        slices = -(-size // most_bytes)
        dealt = blocks.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(slices)))
        copies = rows.join(dealt.select("cell", "block", "slice").distinct(), ["cell", "block"])
        copies = copies.toDF(*copies.columns)  # columns of its own, for the two sides share some

        def meet(qs: pd.DataFrame, rs: pd.DataFrame) -> pd.DataFrame:
            if not len(qs) or not len(rs):
                return pd.DataFrame({"query_id": [], "id": [], "score": []})
            return pd.concat(_met(qs["query_id"].tolist(), _unit(qs["q"].tolist()), rs["id"].tolist(), _unit(rs["v"].tolist()), k, digits))

        key = ["cell", "block", "slice"]
        return dealt.groupBy(*key).cogroup(copies.groupBy(*key)).applyInPandas(meet, found_kinds), blocks.drop("q")

    looked, _ = scored(asked.withColumn("t", F.lit(ALL)), True)
    beat = top(looked.withColumn("score", F.round("score", digits)), k).where(F.col("rank") == k).select("query_id", (F.col("score") - 2 * 10.0**-digits).alias("beat"))
    turned = F.exists("q", lambda x: x != 0)  # a zero query scores 0 everywhere
    t = F.when(turned & F.col("beat").isNotNull(), F.acos(F.greatest(F.least("beat", F.lit(1.0)), F.lit(-1.0))) + SLACK).otherwise(ALL)
    found, read = scored(asked.join(beat, "query_id", "left").select("query_id", "q", t.alias("t")).checkpoint(), False)
    figures = read.groupBy("query_id").agg(F.lit(int(held.sum())).cast("long").alias("n"), F.sum("n").alias("read"))
    return top(found.withColumn("score", F.round("score", digits)), k).select("query_id", "id", "score", "rank"), figures
