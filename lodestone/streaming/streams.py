"""Continuous ingest on Structured Streaming: file sources, keyed dedup, session batches, change detection, staged sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_stream(spark: SparkSession, path: str, per_batch: int = 100) -> DataFrame:
    """path, text of files as they appear; a path is read once."""
    return spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_batch).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def table_stream(spark: SparkSession, path: str, per_batch: int = 1) -> DataFrame:
    """Rows of parquet files as these appear."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def first_seen(stream: DataFrame, keys: list[str], event_time: str | None = None, keep: str = "1 day") -> DataFrame:
    """The first row of each key. With an event time, keys are forgotten after `keep`, so state stays bounded; without, it grows with the keys."""
    if event_time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, keep).dropDuplicatesWithinWatermark(keys)


def session_batches(events: DataFrame, time: str, key: str, gap: str = "30 seconds") -> DataFrame:
    """key, start, end, n: runs of events with no pause of `gap` or more."""
    if events.isStreaming:
        events = events.withWatermark(time, gap)
    return events.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def size_or_gap_batches(stream: DataFrame, key: str, item: str, event_time: str, most: int = 10, gap_ms: int = 30_000, late: str = "0 seconds") -> DataFrame:
    """key, items: batches of `most` items of a key, or of what there is once the next comes, or time goes on, `gap_ms` after the last.

    Time is that of the events, so a stream that is read to its end ends; what is then still held comes by held_back().
    """

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, last = (list(state.get[0]), state.get[1]) if state.exists else ([], 0)
        out = []
        if state.hasTimedOut:
            out, held = ([held] if held else []), []
            state.remove()
        for part in parts:
            for at, x in sorted(zip((part["at"].astype("int64") // 1_000_000).tolist(), part["item"].tolist(), strict=True)):
                if held and at - last >= gap_ms:
                    out.append(held)
                    held = []
                held, last = [*held, x], max(last, at)
                if len(held) >= most:
                    out.append(held)
                    held = []
        if held:
            state.update((held, last))
            state.setTimeoutTimestamp(max(last + gap_ms, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"key": [k[0]] * len(out), "items": out})

    rows = stream.withWatermark(event_time, late).select(F.col(key).cast("string").alias("k"), F.col(event_time).alias("at"), F.col(item).cast("string").alias("item"))
    return rows.groupBy("k").applyInPandasWithState(step, "key string, items array<string>", "held array<string>, last long", "append", GroupStateTimeout.EventTimeTimeout)


def held_back(spark: SparkSession, checkpoint: str) -> DataFrame:
    """key, items that a stopped size_or_gap_batches() still held, from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key").getField("k").alias("key"), F.col("value.groupState.held").alias("items"))


def modified(listing: DataFrame, path: str, mtime: str, seen: str | None = None) -> DataFrame:
    """Listing rows that are new, or later than all rows of the same path seen before (by column seen, else by time): kind is created or modified."""
    order = Window.partitionBy(path).orderBy(seen or mtime).rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(mtime).over(order)
    return listing.withColumn("before", before).withColumn("kind", F.when(F.col("before").isNull(), "created").when(F.col(mtime) > F.col("before"), "modified")).where("kind is not null").drop("before")


def changed(rows: DataFrame, key: str, order_col: str, digest: Column) -> DataFrame:
    """Rows whose digest differs from that of the row of the same key before."""
    order = Window.partitionBy(key).orderBy(order_col)
    marked = rows.withColumn("digest", digest)
    return marked.withColumn("last", F.lag("digest").over(order)).where("last is null or last <> digest").drop("last")


def changed_stream(stream: DataFrame, key: str, digest: str) -> DataFrame:
    """key, digest whenever a key's digest differs from its last one."""

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for part in parts:
            for d in part["d"]:
                if d != last:
                    out.append((k[0], d))
                    last = d
        state.update((last,))
        yield pd.DataFrame(out, columns=["key", "digest"])

    rows = stream.select(F.col(key).cast("string").alias("k"), F.col(digest).cast("string").alias("d"))
    return rows.groupBy("k").applyInPandasWithState(step, "key string, digest string", "last string", "append", GroupStateTimeout.NoTimeout)


def staged(stream: DataFrame, stages: list[Callable[[DataFrame], DataFrame]], sink: str, checkpoint: str, review: Column | None = None, once: bool = True, every: str = "60 seconds") -> StreamingQuery:
    """Each micro-batch through all stages, rows for review apart: written below sink/complete and sink/review, by batch, so a repeated batch overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        for stage in stages:
            batch = batch.transform(stage)
        flag = F.lit(False) if review is None else F.coalesce(review, F.lit(False))
        batch = batch.withColumn("__flag", flag).persist()
        try:
            batch.where("not __flag").drop("__flag").write.mode("overwrite").parquet(f"{sink}/complete/batch={number}")
            if review is not None:
                batch.where("__flag").drop("__flag").write.mode("overwrite").parquet(f"{sink}/review/batch={number}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def run_to_end(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """All that is there now, through to a parquet sink; the sink's rows."""
    query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(sink)
