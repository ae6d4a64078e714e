"""Statistics of corpora, stages and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ["pending", "parsing", "tier1", "tier2", "validation", "complete", "failed"]


def counts(df: DataFrame, column: str) -> DataFrame:
    """value, n: a missing value counts as unknown, an empty one as itself."""
    return df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("value")).agg(F.count("*").alias("n"))


def totals(df: DataFrame, length: Column, code_size: Column) -> DataFrame:
    """total, with_code, avg_length (rounded down)."""
    return df.agg(F.count("*").alias("total"), F.count_if(code_size > 0).alias("with_code"), F.floor(F.sum(length) / F.greatest(F.count("*"), F.lit(1))).alias("avg_length"))


def zero_filled(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """value, n for each of the values, also those that do not occur."""
    dim = df.sparkSession.createDataFrame([(v, k) for k, v in enumerate(values)], "value string, ord int")
    return dim.join(df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("c")), "value", "left").select("value", F.coalesce("c", F.lit(0)).cast("long").alias("n"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and rows that have each column."""
    return df.agg(F.count("*").alias("total"), *[F.count(c).alias(f"has_{c}") for c in columns])


def pooled_groups(df: DataFrame, column: str, least: int = 10, pool: str = "misc") -> DataFrame:
    """Rows with `grp`: their own group if it has at least so many rows, else the pool. Small sizes are joined back, no window over hot groups."""
    sizes = df.groupBy(column).agg(F.count("*").alias("__n"))
    return df.join(sizes, column).withColumn("grp", F.when(F.col("__n") >= least, F.col(column)).otherwise(pool)).drop("__n")


def keywords(df: DataFrame, group: str, lists: list[Column], most: int = 50) -> DataFrame:
    """group, keywords: the first keywords in alphabetical order, lower-cased and distinct."""
    words = df.select(group, F.explode(F.concat(*lists)).alias("k")).select(group, F.trim(F.lower("k")).alias("k")).where("k <> ''").distinct()
    order = Window.partitionBy(group).orderBy("k")
    return words.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).groupBy(group).agg(F.array_sort(F.collect_list("k")).alias("keywords"))
