"""Exact top-k inner-product search by Fagin's threshold algorithm.

Rows are dealt into blocks and so are queries; each pair of blocks is one task. In a block every dimension has its rows in
order of their component. A query walks all lists at once, from the end that its own sign favours, scores each row that
it meets for the first time in full (random access), and stops when the bound, the sum over dimensions of its component
times the value last met there, is under its k-th best score: no row not yet met can then enter, nor tie. Each block gives
k rows for a query, and a ranked merge keeps the best k of all blocks.

Cases: vectors that are null or hold a null, NaN or infinite component take no part, neither as rows nor as queries.
Shorter vectors count as padded with zeros. Ties go to the smaller id. A row never answers a query of its own id. A
repeated id asks once (with its smallest vector) and answers as often as it stands. Components are clipped to +-2^53 and
scores to 64 bits. Rows of null id take no part. An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "query_id long, vec_id long, score long"
FIRST_DEPTH = 8
ROWS, QUERIES = 8192, 2048  # of a block


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


class SortedLists:
    """The rows of a block with one sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, exact: type) -> None:
        self.ids, self.rows = ids, rows.astype(exact)
        self.down = np.argsort(-rows, axis=0, kind="stable")
        self.values = np.take_along_axis(self.rows, self.down, 0)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best rows, and how many rows were met."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        weight = query[dims]
        met = self.ids == own
        scores = np.zeros(0, self.rows.dtype)
        places = np.zeros(0, np.int64)
        depth, step = 0, FIRST_DEPTH
        if not len(dims):  # every row scores 0
            places = np.flatnonzero(~met)
            scores = np.zeros(len(places), self.rows.dtype)
            depth = n
        up = weight < 0
        while depth < n:
            end = min(n, depth + step)
            if 2 * len(places) > n:  # most rows are met already: meet the rest
                end = n
                new = np.flatnonzero(~met)
            else:
                fresh = np.zeros(n, bool)
                fresh[self.down[depth:end, dims[~up]].ravel()] = True
                fresh[self.down[n - end : n - depth, dims[up]].ravel()] = True
                new = np.flatnonzero(fresh & ~met)
            met[new] = True
            places = np.concatenate((places, new))
            scores = np.concatenate((scores, self.rows[new] @ query))
            depth, step = end, step * 2
            if len(scores) >= k and depth < n:
                last = np.where(up, self.values[n - depth, dims], self.values[depth - 1, dims])
                if last @ weight < np.partition(scores, len(scores) - k)[len(scores) - k]:
                    break
        count = len(places)
        if len(scores) > k:
            keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            places, scores = places[keep], scores[keep]
        best = _best(self.ids[places], scores, k)
        return self.ids[places[best]], scores[best], count


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _cell(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        if not len(queries) or not len(rows):
            return empty
        width = max(map(len, [*queries.v, *rows.v]))
        q, x = _matrix(queries.v, width), _matrix(rows.v, width)
        largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(width, 1)
        exact = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 62 else object
        lists = SortedLists(rows.id.to_numpy(np.int64), x, exact)
        out = []
        for own, query in zip(queries.id.to_numpy(np.int64), q.astype(exact), strict=True):
            ids, scores, _ = lists.top(own, query, k)
            scores = np.clip(scores, -(1 << 63), (1 << 63) - 1) if exact is object else scores
            out.append(pd.DataFrame({"query_id": np.full(len(ids), own), "vec_id": ids, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else empty

    return run


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null if the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    most = float(1 << 53)
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * scale))).cast("long")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the highest inner product for each query, of quantised vectors."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), quantised(vectors[vector_col], scale).alias("v")).where("v is not null and id is not null")
    asked = queries.select(queries[id_col].cast("long").alias("id"), quantised(queries[vector_col], scale).alias("v")).where("v is not null and id is not null")
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    n, m = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n // ROWS)), max(1, -(-m // QUERIES))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)).cast("array<long>")))

    left = dealt(asked, "q", query_blocks, "r", row_blocks).groupBy("q", "r")
    right = dealt(rows, "r", row_blocks, "q", query_blocks).groupBy("q", "r")
    best = left.cogroup(right).applyInPandas(_cell(k), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
