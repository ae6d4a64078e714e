"""Retrieval quality: precision, recall, reciprocal rank and discounted gain of ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def relevant(text: Column, patterns: Column, least: int = 2) -> Column:
    """Whether at least so many of a query's patterns occur in a text."""
    return F.size(F.filter(patterns, lambda p: F.contains(F.lower(text), F.lower(p)))) >= least


def judged(chunks: DataFrame, text: Column, patterns: DataFrame, least: int = 2) -> DataFrame:
    """query_id, id of the relevant chunks (column id). patterns: query_id, patterns: a stated set of queries, read from every chunk at once."""
    asked = patterns.collect()
    if not asked:
        return chunks.select(F.lit(None).cast("string").alias("query_id"), "id").limit(0)
    said = chunks.select("id", F.lower(text).alias("said"))  # once, not for each pattern
    held = lambda patterns: sum((F.contains("said", F.lower(F.lit(p))).cast("int") for p in patterns), F.lit(0))
    hits = F.array_compact(F.array(*[F.when(held(r.patterns) >= least, F.lit(r.query_id)) for r in asked]))
    return said.select(F.explode(hits).alias("query_id"), "id")


def metrics(results: DataFrame, judged: DataFrame, k: int = 10, first: int = 5) -> DataFrame:
    """One row a query. results: query_id, id, rank. judged: query_id, id of all relevant records.

    Precision divides by the results returned; the ideal gain is that of the relevant results retrieved, and ndcg_full's
    that of all relevant records; recall is 0 where nothing is relevant.
    """
    marked = results.where(F.col("rank") <= k).join(judged.withColumn("rel", F.lit(1)), ["query_id", "id"], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))
    gain = F.col("rel") / F.log2(F.col("rank") + 1)
    per = marked.groupBy("query_id").agg(
        F.count("*").alias("returned"),
        F.sum("rel").alias("hits"),
        F.avg(F.when(F.col("rank") <= first, F.col("rel").cast("double"))).alias("p_first"),
        F.avg(F.col("rel").cast("double")).alias("p_all"),
        F.coalesce(1 / F.min(F.when(F.col("rel") == 1, F.col("rank"))), F.lit(0.0)).alias("mrr"),
        F.sum(gain).alias("dcg"),
    )
    total = judged.groupBy("query_id").agg(F.count("*").alias("relevant"))
    out = per.join(total, "query_id", "left").withColumn("relevant", F.coalesce("relevant", F.lit(0)))

    def ideal(n: Column) -> Column:
        return F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    verdict = F.when((F.col("p_first") >= 0.4) & (F.col("mrr") > 0), "PASS").when(F.col("mrr") > 0, "WEAK").otherwise("FAIL")
    r4 = lambda c: F.round(c, 4)
    return out.select(
        "query_id", "returned", "relevant", r4("p_first").alias("p_first"), r4("p_all").alias("p_all"), r4(ratio(F.col("hits").cast("double"), F.col("relevant"))).alias("recall"), r4("mrr").alias("mrr"),
        r4(ratio(F.col("dcg"), ideal(F.col("hits")))).alias("ndcg"), r4(ratio(F.col("dcg"), ideal(F.least("relevant", F.lit(k))))).alias("ndcg_full"), verdict.alias("verdict"),
    )


def has_required(results: DataFrame, calls: DataFrame, required: DataFrame) -> DataFrame:
    """query_id, has_required: whether any result holds any required call (true where none is required). calls: id, calls. required: query_id, required."""
    hit = results.join(calls, "id").join(required, "query_id").groupBy("query_id").agg(F.bool_or(F.arrays_overlap("calls", "required")).alias("hit"))
    return required.join(hit, "query_id", "left").select("query_id", ((F.size("required") == 0) | F.coalesce("hit", F.lit(False))).alias("has_required"))


def summary(per_query: DataFrame) -> DataFrame:
    """Means over queries and the share that passes."""
    means = [F.round(F.avg(F.col(c).cast("decimal(12,4)")), 4).cast("double").alias(c) for c in ("p_first", "p_all", "recall", "mrr", "ndcg", "ndcg_full")]
    return per_query.agg(F.count("*").alias("queries"), *means, F.round(F.avg((F.col("verdict") == "PASS").cast("double")), 4).alias("pass_rate"))
