"""A text index that is updated: segments with deletions, sums over segments, merges, and top-k search that skips blocks by their bounds.

A segment holds its documents in the order of their length within each part, RANGE of them to a range, with the counts of their terms (docs), and for each term and range one
block of postings with the largest count and the smallest length in it (blocks, in the order of terms within each bucket). What a block's documents can score at most follows from these two, whatever
the average length is then. A deletion is a table of ids that are gone from all segments before it, with what these took from the terms' figures. A manifest names segments
and deletions; the next version is written beside and renamed to its number, so readers keep the snapshot that they opened, and of two writers one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import hadoop
from .graph import freeing, shared_folder
from .search import B, K1, _few, counted, query_terms, top

RANGE_BITS = 3  # a range has 2^3 documents
DEALT = 1 << 20  # tokens whose postings are made into blocks in one group
SPREAD = 1 << 19  # documents whose postings of one term are
AT_ONCE = 1 << 20  # ids of a deletion that are sent to every task
FIRST = 48  # ranges a query looks at first, as a multiple of k documents, to learn what a k-th score must beat
LOOKS = 2  # times that it does


@dataclass
class Snapshot:
    """One version of an index."""

    spark: SparkSession
    folder: str
    version: int
    segments: list[dict]  # name, born
    deletions: list[dict]  # name, born
    n: int
    tokens: int

    def _all(self, table: str, names: list[str]) -> DataFrame:
        found = None
        for name in names:
            part = self.spark.read.parquet(f"{self.folder}/{name}/{table}").withColumn("segment", F.lit(name))
            found = part if found is None else found.unionByName(part)
        return found

    def _gone(self) -> DataFrame | None:
        """segment, id of what deletions took from segments."""
        found = None
        for d in self.deletions:
            before = [s["name"] for s in self.segments if s["born"] < d["born"]]
            if before:
                part = self.spark.read.parquet(f"{self.folder}/{d['name']}/ids").select(F.explode(F.array(*map(F.lit, before))).alias("segment"), "id")
                found = part if found is None else found.unionByName(part)
        return found

    def documents(self) -> DataFrame | None:
        """segment, id, dl, range, terms (term, tf) of the documents that are there."""
        docs = self._all("docs", [s["name"] for s in self.segments])
        gone = self._gone()
        return docs if docs is None or gone is None else docs.join(gone, ["segment", "id"], "left_anti")

    def blocks(self) -> DataFrame | None:
        return self._all("blocks", [s["name"] for s in self.segments])

    def terms(self) -> DataFrame | None:
        """term, df, cf over all segments and deletions."""
        parts = self._all("terms", [x["name"] for x in (*self.segments, *self.deletions)])
        return None if parts is None else parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).where("df > 0")


def open_snapshot(spark: SparkSession, folder: str) -> Snapshot:
    """The latest version."""
    versions = [int(n[9:-5]) for n in hadoop.names(spark, folder) if n.startswith("manifest-") and n.endswith(".json")]
    if not versions:
        return Snapshot(spark, folder, 0, [], [], 0, 0)
    known = json.loads(hadoop.read_text(spark, f"{folder}/manifest-{max(versions):08d}.json"))
    return Snapshot(spark, folder, max(versions), known["segments"], known["deletions"], known["n"], known["tokens"])


def _commit(old: Snapshot, segments: list[dict], deletions: list[dict], n: int, tokens: int) -> Snapshot:
    body = json.dumps({"segments": segments, "deletions": deletions, "n": n, "tokens": tokens})
    if not hadoop.publish(old.spark, f"{old.folder}/manifest-{old.version + 1:08d}.json", body):
        raise RuntimeError(f"version {old.version + 1} of {old.folder} was written by another")
    return Snapshot(old.spark, old.folder, old.version + 1, segments, deletions, n, tokens)


def _store(forward: DataFrame, place: str) -> tuple[int, int]:
    """A segment of documents (id, dl, terms): how many, and how many tokens. Documents stay where they are read; postings are sent once, packed by buckets of terms."""
    spark = forward.sparkSession
    ordered = forward.select("id", "dl", "terms").sortWithinPartitions("dl", "id").withColumn("row", F.monotonically_increasing_id())
    with freeing(spark):
        ordered.withColumns({"range": F.shiftright("row", RANGE_BITS), "slot": F.col("row").bitwiseAND((1 << RANGE_BITS) - 1).cast("int")}).drop("row").write.option("compression", "zstd").parquet(f"{place}/docs")
        docs = spark.read.parquet(f"{place}/docs")
        n, tokens = docs.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-tokens // DEALT))
        _blocks(docs.select("id", "dl", "range", "terms", "slot"), buckets, max(1, -(-n // SPREAD))).write.option("compression", "zstd").parquet(f"{place}/blocks")
        spark.read.parquet(f"{place}/blocks").groupBy("term").agg(F.sum("n").alias("df"), F.sum("cf").alias("cf")).write.parquet(f"{place}/terms")
    return n, tokens


SLICE = 1_000  # documents of a batch whose postings are dealt at once


def _blocks(docs: DataFrame, buckets: int, spread: int) -> DataFrame:
    """term, range, docs (id, tf, dl; at most RANGE of them), most, least, n, cf, slots (a bit for each document of the range that has the term). A term's postings go to one bucket for each of `spread` sets of parts, so that one in all documents burdens no bucket."""
    kind = docs.schema["id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            held, size = pc.list_flatten(batch.column(3)), pc.fill_null(pc.list_value_length(batch.column(3)), 0).to_numpy()
            if not len(held):
                continue
            coded = pc.struct_field(held, "term").dictionary_encode()
            code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            doc = np.repeat(np.arange(batch.num_rows), size)
            part = (batch.column(2).to_numpy() >> (33 - RANGE_BITS)) % spread  # monotonically_increasing_id() has the part above 33 bits
            h = pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)[code] + part[doc].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((code, bucket))
            bucket, code, doc = bucket[order], code[order], pa.array(doc[order])
            begins = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (code[1:] != code[:-1])))  # of a term's postings
            some, at = np.unique(bucket, return_index=True)
            cut, of = pa.array(np.append(at, len(bucket)).astype(np.int32)), pa.array(np.append(np.searchsorted(begins, at), len(begins)).astype(np.int32))
            terms = [pa.ListArray.from_arrays(of, x) for x in (words.take(pa.array(code[begins])), pa.array(np.diff(np.append(begins, len(bucket))).astype(np.int32)))]
            tf = pc.struct_field(held, "tf").take(pa.array(order))
            posted = [pa.ListArray.from_arrays(cut, x) for x in (batch.column(0).take(doc), batch.column(1).take(doc), batch.column(2).take(doc), tf, batch.column(4).take(doc))]
            yield pa.RecordBatch.from_arrays([pa.array(some), *terms, *posted], ["bucket", "term", "times", "id", "dl", "range", "tf", "slot"])

    def gather(rows: pa.Table) -> pa.Table:
        term, times, ids, dl, ranges, tf, slot = (pa.concat_arrays([pc.list_flatten(c) for c in rows[k].chunks]) for k in ("term", "times", "id", "dl", "range", "tf", "slot"))
        coded = term.dictionary_encode()
        sort = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(sort), np.int64)
        rank[sort.to_numpy()] = np.arange(len(sort))
        which = np.repeat(rank[coded.indices.to_numpy()], times.to_numpy())
        order = np.lexsort((ranges.to_numpy(), which))
        which, at, tf, dl = which[order], ranges.to_numpy()[order], tf.to_numpy()[order], dl.to_numpy()[order]
        begins = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (at[1:] != at[:-1])))
        posted = pa.StructArray.from_arrays([ids.take(pa.array(order)), pa.array(tf), pa.array(dl)], ["id", "tf", "dl"])
        held = pa.ListArray.from_arrays(pa.array(np.append(begins, len(which)).astype(np.int32)), posted)
        n = np.diff(np.append(begins, len(which))).astype(np.int32)
        figures = [pa.array(x) for x in (np.maximum.reduceat(tf, begins), np.minimum.reduceat(dl, begins), n, np.add.reduceat(tf, begins), np.bitwise_or.reduceat(1 << slot.to_numpy()[order], begins).astype(np.int32))]
        return pa.table([coded.dictionary.take(sort).take(pa.array(which[begins])), pa.array(at[begins]), held, *figures], ["term", "range", "docs", "most", "least", "n", "cf", "slots"])

    sent = docs.mapInArrow(deal, f"bucket bigint, term array<string>, times array<int>, id array<{kind}>, dl array<bigint>, range array<bigint>, tf array<bigint>, slot array<int>")
    return sent.groupBy("bucket").applyInArrow(gather, f"term string, range bigint, docs array<struct<id:{kind},tf:bigint,dl:bigint>>, most bigint, least bigint, n int, cf bigint, slots int")


def forward(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """id, dl, terms (term, tf) of documents, also those without a term; rows of an id beyond its first (by text) do not count. Texts are sent only where an id is there twice."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.min("t").alias("t"))
    return counted(rows, "id", F.col("t"))


def delete(index: Snapshot, ids: DataFrame) -> Snapshot:
    """The next version, without the documents of these ids (column id); ids that are not there do nothing."""
    docs = index.documents()
    if docs is None:
        return index
    spark = index.spark
    born = index.version + 1
    place = f"deletion-{born}-{uuid.uuid4().hex[:8]}"
    with freeing(spark):
        docs.select("segment", "id", "dl").join(ids.select("id").distinct(), "id", "left_semi").write.parquet(f"{index.folder}/{place}/ids")
        lost = spark.read.parquet(f"{index.folder}/{place}/ids")
        found = {r.segment: r.n for r in lost.groupBy("segment").agg(F.count("*").alias("n")).collect()}  # a few segments
        for name, many in (found or {index.segments[0]["name"]: 0}).items():
            turns = max(1, -(-many // AT_ONCE))
            for turn in range(turns):  # so many ids go to the documents, which are not sent
                mine = lost.where((F.col("segment") == name) & (F.pmod(F.xxhash64("id"), F.lit(turns)) == turn)).select("id")
                taken = spark.read.parquet(f"{index.folder}/{name}/docs").join(F.broadcast(mine), "id", "left_semi").select(F.explode("terms").alias("t"))
                taken.groupBy("t.term").agg((-F.count("*")).alias("df"), (-F.sum("t.tf")).alias("cf")).write.mode("append").parquet(f"{index.folder}/{place}/terms")
    n, tokens = lost.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
    return _commit(index, index.segments, [*index.deletions, {"name": place, "born": born}], index.n - n, index.tokens - tokens)


def add(index: Snapshot, docs: DataFrame, id_col: str, text: Column) -> Snapshot:
    """The next version, with these documents; those of an id that is there take its place."""
    rows = forward(docs, id_col, text)
    born = index.version + 1
    place = f"segment-{born}-{uuid.uuid4().hex[:8]}"
    n, tokens = _store(rows, f"{index.folder}/{place}")
    new = index.spark.read.parquet(f"{index.folder}/{place}/docs")
    if index.segments and new.select("id").join(index.documents().select("id"), "id", "left_semi").limit(1).count():
        index = delete(index, new.select("id"))
        born = index.version + 1
    return _commit(index, [*index.segments, {"name": place, "born": born}], index.deletions, index.n + n, index.tokens + tokens)


def merge(index: Snapshot) -> Snapshot:
    """The next version: one segment of all that is there, and no deletions. Older versions stay readable until vacuum()."""
    docs = index.documents()
    if docs is None:
        return index
    place = f"segment-{index.version + 1}-{uuid.uuid4().hex[:8]}"
    _store(docs, f"{index.folder}/{place}")
    return _commit(index, [{"name": place, "born": index.version + 1}], [], index.n, index.tokens)


def vacuum(index: Snapshot) -> list[str]:
    """Removes what this version, the latest, does not name; the names. Readers of older versions lose them."""
    kept = {x["name"] for x in (*index.segments, *index.deletions)}
    old = [n for n in hadoop.names(index.spark, index.folder) if (n.startswith(("segment-", "deletion-")) and n not in kept) or (n.startswith("manifest-") and n != f"manifest-{index.version:08d}.json")]
    for name in old:
        hadoop.remove(index.spark, f"{index.folder}/{name}")
    return old


def search(index: Snapshot, queries: DataFrame, query_col: str, query_text: Column, k: int = 20, digits: int = 6) -> tuple[DataFrame, DataFrame]:
    """query_id, id, score, rank by BM25, exactly; and how far blocks were skipped: query_id, postings (of its terms), read.

    A block bounds what its documents can score by its term, and tells which of its range's documents have it, so bounds are summed for each document. Each query first scores in full the ranges with the largest sums of bounds; the k-th score there is one that others must
    beat. In each other range, terms whose bounds together cannot beat it are left unread: documents are found by the remaining terms alone, of which a range may have none, and only
    where one of them might still beat the score are the other terms' blocks read.
    """
    spark = index.spark
    shared_folder(spark)
    wanted = query_terms(queries, query_col, query_text)
    terms, blocks = index.terms(), index.blocks()
    if terms is None:
        kind = queries.schema[query_col].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, id long, score double, rank int"), spark.createDataFrame([], f"query_id {kind}, postings long, read long")
    few = _few(wanted)
    if few is not None:  # of blocks in the order of terms only theirs are read
        asked = F.col("term").isin(few) if few else F.lit(False)
        terms, blocks = terms.where(asked), blocks.where(asked)
    n, average = float(index.n), index.tokens / index.n if index.n else 1.0
    idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    weights = wanted.join(terms, "term").select("query_id", "term", (idf * F.col("times")).alias("w"))
    where, gone = ["query_id", "segment", "range"], index._gone()

    def impact(tf: Column, dl: Column) -> Column:
        tf = tf.cast("double")
        return F.col("w") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / average))

    def parts(heads: DataFrame) -> DataFrame:
        """query_id, segment, range, id, part of the blocks of heads (query_id, segment, range, term, w)."""
        held = blocks.select("segment", "range", "term", "docs").join(heads.select(*where, "term", "w"), ["segment", "range", "term"])
        hits = held.select(*where, "w", F.explode("docs").alias("d")).select(*where, "d.id", impact(F.col("d.tf"), F.col("d.dl")).alias("part"))
        return hits if gone is None else hits.join(gone, ["segment", "id"], "left_anti")

    with freeing(spark):
        heads = blocks.select("segment", "range", "term", "most", "least", "n", "slots").join(weights, "term").withColumn("bound", impact(F.col("most"), F.col("least"))).checkpoint()
        with_term = [F.when(F.col("slots").bitwiseAND(1 << j) != 0, F.col("bound")).otherwise(0.0) for j in range(1 << RANGE_BITS)]
        ranges = heads.groupBy(*where).agg(F.greatest(*map(F.sum, with_term)).alias("all"))  # the most that one of a range's documents can score
        looks = max(1, -(-k * FIRST >> RANGE_BITS))
        best = Window.partitionBy("query_id").orderBy(F.desc("all"), "segment", "range")
        ranges = ranges.withColumn("look", F.row_number().over(best)).where(F.col("look") <= LOOKS * looks).checkpoint()
        slack = 2 * 10.0**-digits  # rounded scores may tie where exact ones do not
        first = looked = beat = None
        for turn in range(LOOKS):  # what is found in one look is to be beaten in the next
            mine = ranges.where((F.col("look") > turn * looks) & (F.col("look") <= (turn + 1) * looks))
            mine = mine if beat is None else mine.join(beat, "query_id", "left").where(F.col("beat").isNull() | (F.col("all") >= F.col("beat")))
            mine = mine.select(*where).checkpoint()
            scored = parts(heads.join(mine, where, "left_semi")).groupBy("query_id", "id").agg(F.round(F.sum("part"), digits).alias("score")).checkpoint()
            first, looked = (scored, mine) if first is None else (first.unionByName(scored), looked.unionByName(mine))
            beat = top(first, k).where(F.col("rank") == k).select("query_id", (F.col("score") - slack).alias("beat")).checkpoint()
        head = heads.join(looked, where, "left_semi")
        upwards = Window.partitionBy(*where).orderBy("bound", "term")
        rest = heads.join(looked, where, "left_anti").join(beat, "query_id", "left").withColumn("beat", F.coalesce("beat", F.lit(-1.0)))
        rest = rest.withColumn("sum", F.greatest(*[F.sum(b).over(upwards) for b in with_term])).withColumn("needed", F.col("sum") >= F.col("beat")).checkpoint()
        other = rest.where("not needed").groupBy(*where).agg(F.greatest(*map(F.sum, with_term)).alias("more"))
        some = parts(rest.where("needed")).groupBy(*where, "id").agg(F.sum("part").alias("part")).join(other, where, "left").join(beat, "query_id", "left")
        some = some.where(F.col("beat").isNull() | (F.col("part") + F.coalesce("more", F.lit(0.0)) >= F.col("beat"))).select(*where, "id", "part").checkpoint()
        late = rest.where("not needed").join(some.select(*where).distinct(), where, "left_semi").checkpoint()
        more = parts(late).join(some.select(*where, "id"), [*where, "id"], "left_semi")
        found = some.unionByName(more).groupBy("query_id", "id").agg(F.round(F.sum("part"), digits).alias("score"))
        read = head.select("query_id", "n").unionByName(rest.where("needed").select("query_id", "n")).unionByName(late.select("query_id", "n"))
        figures = heads.groupBy("query_id").agg(F.sum("n").alias("postings")).join(read.groupBy("query_id").agg(F.sum("n").alias("read")), "query_id")
    return top(first.unionByName(found), k).select("query_id", "id", "score", "rank"), figures
