"""Connected components and prerequisite edges."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import packs as P
from ..functions.rules import matches
from ..sources import hadoop


def shared_folder(spark) -> None:
    """Sets the checkpoint folder that the cluster names; one of our own only on one machine, where every folder is shared."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="lodestone-checkpoint-")
    sc.setCheckpointDir(folder)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Within it, an action's shuffle files are removed once it has ended; what it read must be there to be read again, as checkpoints and stored() are."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def stored(df: DataFrame, place: str) -> DataFrame:
    """df, written below the shared folder and read again; whoever asks for it removes it.

    Unlike a checkpoint, which keeps its plan's estimate of its size, it has that of its files. Estimates of joins are products: over the rounds of a loop their digits
    double with each, until they fill the driver's memory.
    """
    with freeing(df.sparkSession):
        df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def scratch(spark: SparkSession) -> str:
    """The name of a new folder in the shared one."""
    shared_folder(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/scratch-{uuid.uuid4().hex}"


MANY = 10_000  # most rows that are sent to every task


def labelled(rows: DataFrame, labels: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows with the columns of labels, which has one row a key. Keys of very many rows, at most MANY of them by their counts, are sent to the rows; the rest meet theirs by a join.

    rows are read more than once: a checkpoint, or what is cheap to make again.
    """
    often = max(64, rows.count() // MANY)
    keys = F.broadcast(rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > often).select(key))
    hot = labels.join(keys, key, "left_semi")
    return rows.join(keys, key, "left_semi").join(F.broadcast(hot), key, how).unionByName(rows.join(keys, key, "left_anti").join(labels, key, how))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for each node of the edges.

    Labels travel to neighbours and on to labels of labels, so the rounds grow with the logarithm of a chain's length.
    Each round is stored() in the shared folder and removed after the next: lineage, estimates and disk stay small and executors may be lost.
    """
    spark = edges.sparkSession
    folder = scratch(spark)
    try:
        pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        both = stored(pairs.union(pairs.select("b", "a")).where("a <> b").distinct(), f"{folder}/edges")
        label = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
        for k in range(rounds):
            near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
            least = stored(label.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")), f"{folder}/least-{k}")
            up = least.select(F.col("node").alias("component"), F.col("component").alias("up"))
            new = stored(labelled(least, up, "component", "left").select("node", "old", F.least("component", F.coalesce("up", "component")).alias("component")), f"{folder}/new-{k}")
            for old in (f"least-{k}", f"new-{k - 1}"):
                hadoop.remove(spark, f"{folder}/{old}")
            label = new.select("node", "component")
            if new.where("old <> component").limit(1).count() == 0:
                return label.checkpoint()
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    finally:
        hadoop.remove(spark, folder)


def concept_intros(chunks: DataFrame, text: Column, top: int) -> DataFrame:
    """concept, id, place: the chunks that introduce each concept, by authority and then corpus order (columns authority, ord)."""
    read = chunks.withColumn("__said", text).withColumn("__lower", F.lower("__said"))
    hits = F.array_compact(F.array(*[F.when(matches(F.col("__said"), f"(?i){p}", F.col("__lower")), F.lit(c)) for c, p in P.CONCEPT_INTROS.items()]))
    found = read.select("id", "authority", "ord", F.explode(hits).alias("concept"))
    order = Window.partitionBy("concept").orderBy(F.desc("authority"), "ord")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select("concept", "id", "place")


def first_of_episodes(chunks: DataFrame) -> DataFrame:
    """episode, id: the first chunk (by ord) of each episode; chunks without one are left out."""
    return chunks.where("episode is not null").groupBy("episode").agg(F.min_by("id", "ord").alias("id"))


def mentions(chunks: DataFrame, text: Column) -> DataFrame:
    """id, episode: the episodes that a text names, each once."""
    found = F.regexp_extract_all(text, F.lit(P.MENTION), F.lit(1))
    return chunks.select("id", F.explode(F.array_distinct(F.transform(found, lambda n: n.try_cast("long")))).alias("episode")).where("episode is not null")


def graph_stats(edges: DataFrame, intros: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row: chunks with prerequisites, links, concepts introduced, episodes."""
    links = edges.select("src", "dst").distinct().agg(F.countDistinct("src").alias("chunks_with_prereqs"), F.count("*").alias("total_links"))
    return links.crossJoin(intros.agg(F.countDistinct("concept").alias("concepts"))).crossJoin(episodes.agg(F.count("*").alias("episodes")))


def call_concepts(spark) -> DataFrame:
    return spark.createDataFrame([*P.CALL_CONCEPTS.items()], "call string, concept string")


def prerequisite_edges(chunks: DataFrame, intros: DataFrame, episodes: DataFrame, mentions: DataFrame) -> DataFrame:
    """src, dst, rule. chunks: id, calls. intros: concept_intros(). episodes: episode, id (first chunk). mentions: id, episode.

    Rules: an episode needs the one before; a call needs the two best introductions of its concept (the cut comes
    before leaving out the chunk itself); a mention needs the episode it names.
    """
    before = episodes.select((F.col("episode") + 1).alias("episode"), F.col("id").alias("dst"))
    chain = episodes.join(before, "episode").where("episode > 1").select(F.col("id").alias("src"), "dst", F.lit("episode").alias("rule"))
    used = chunks.select(F.col("id").alias("src"), F.explode("calls").alias("call")).join(F.broadcast(call_concepts(chunks.sparkSession)), "call").select("src", "concept").distinct()
    needs = used.join(intros.where("place <= 2").select("concept", F.col("id").alias("dst")), "concept").where("src <> dst").select("src", "dst", F.lit("concept").alias("rule"))
    named = mentions.select(F.col("id").alias("src"), "episode").distinct().join(episodes.select("episode", F.col("id").alias("dst")), "episode").select("src", "dst", F.lit("mention").alias("rule"))
    return chain.unionByName(needs).unionByName(named).distinct()


def merge_prerequisites(chunks: DataFrame, edges: DataFrame) -> DataFrame:
    """Chunks with prerequisites joined by the edges' targets, sorted and distinct."""
    found = edges.groupBy(F.col("src").alias("id")).agg(F.collect_set("dst").alias("found"))
    none = F.array().cast("array<string>")
    return chunks.join(found, "id", "left").withColumn("prerequisites", F.array_sort(F.array_union(F.coalesce("prerequisites", none), F.coalesce("found", none)))).drop("found")
