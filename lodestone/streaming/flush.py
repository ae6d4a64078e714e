"""Batches by size or time as keyed state: rows are held in list state until a shard has so many, or a processing-time timer fires.

What is held is part of the stream's checkpoint, so a row leaves once: if the process ends before a micro-batch is committed, the batch is run
again on the state as it was before, with the same time, and gives the same flushes under the same numbers. The file sink forgets the first
attempt by its log; a consumer is given flushes by shard and number, and overwrites by them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lodestone.sources.hadoop import append_text

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times keep their microseconds and nulls their fields in the text that state holds.
AS_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


@dataclass(frozen=True)
class FlushPolicy:
    """When what a shard holds is passed on: so many rows, or so many seconds since its last flush (or, by since="add", since its last row)."""

    rows: int
    seconds: float
    since: str = "flush"

    def deadline(self, flushed: int, added: int) -> int:
        """In milliseconds, from the times of the last flush and the last row."""
        return (added if self.since == "add" else flushed) + int(self.seconds * 1000)


#: Exports go out at 50 rows or each minute, a daemon's batches at 5 rows or 5 seconds, a watcher's at 10 rows or 30 seconds without a new one.
EXPORT, DAEMON, WATCHER = FlushPolicy(50, 60.0), FlushPolicy(5, 5.0), FlushPolicy(10, 30.0, "add")


class Flusher(StatefulProcessor):
    """Holds a shard's rows as text; a row without text is a mark that passes on all that is held."""

    def __init__(self, policy: FlushPolicy) -> None:
        self.policy = policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "row string")
        # number of the next flush, rows held, time of the last flush and of the last row, timer that is set (0: none)
        self.turn = handle.getValueState("turn", "flush long, n long, flushed long, added long, timer long")

    def _set(self, flush: int, n: int, flushed: int, added: int, timer: int) -> None:
        due = self.policy.deadline(flushed, added) if n else 0
        if timer != due:
            if timer:
                self.handle.deleteTimer(timer)
            if due:
                self.handle.registerTimer(due)
        self.turn.update((flush, n, flushed, added, due))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        flush, n, flushed, added, timer = self.turn.get() if self.turn.exists() else (0, 0, now, now, 0)
        came = pd.concat(rows).sort_values("place", kind="stable")
        marked, new = bool(came["row"].isna().any()), came["row"].dropna().tolist()
        if new:
            added = now
        most = self.policy.rows
        late = n + len(new) > 0 and now >= self.policy.deadline(flushed, added)
        if n + len(new) < most and not marked and not late:
            if new:
                self.held.appendList([(r,) for r in new])
            self._set(flush, n + len(new), flushed, added, timer)
            return
        all_ = ([r for (r,) in self.held.get()] if n else []) + new
        cuts = list(range(0, len(all_), most))
        out = [all_[a : a + most] for a in cuts]
        rest = out.pop() if out and len(out[-1]) < most and not (marked or late) else []
        if out:
            flushed = now
            yield pd.DataFrame({"shard": key[0], "flush": [flush + k for k, part in enumerate(out) for _ in part], "row": [r for part in out for r in part]})
        self.held.put([(r,) for r in rest]) if rest else self.held.clear()
        self._set(flush + len(out), len(rest), flushed, added, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        flush, n, _, added, timer = self.turn.get()
        if expiredTimerInfo.getExpiryTimeInMs() != timer:
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        if n:
            yield pd.DataFrame({"shard": key[0], "flush": [flush] * n, "row": [r for (r,) in self.held.get()]})
        self.held.clear()
        self.turn.update((flush + (n > 0), 0, now, added, 0))

    def close(self) -> None:
        pass


def batches(stream: DataFrame, policy: FlushPolicy, shards: int | None = None, order: str | None = None, marks: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """shard, flush, and the stream's columns: its rows in batches of a shard, by hash or by an integer column that names it (key, from 0).

    shards: as many as the session's shuffle partitions, or one for batches over all rows; one stream keeps one number of them. Its query needs PROVIDER for its state, as flushing() sets it. order: a column that orders the rows of a micro-batch. marks: a stream with a column shard, null for all; a row passes on what is held.
    """
    spark = stream.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.col(order).cast("string") if order else F.lit("")
    if order and dict(stream.dtypes)[order] in ("tinyint", "smallint", "int", "bigint"):
        place = F.lpad((F.col(order).cast("decimal(20, 0)") + F.expr(f"{2**63}bd")).cast("string"), 20, "0")
    rows = stream.select((F.col(key) if key else F.pmod(F.xxhash64(F.struct("*")), F.lit(shards))).cast("int").alias("shard"), place.alias("place"), F.to_json(F.struct("*"), AS_TEXT).alias("row"))
    if marks is not None:
        rows = rows.unionByName(marks.select(F.explode(F.when(F.col("shard").isNull(), F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(F.array("shard"))).alias("shard"), F.lit("").alias("place"), F.lit(None).cast("string").alias("row")))
    held = rows.groupBy("shard").transformWithStateInPandas(Flusher(policy), "shard int, flush long, row string", "append", "processingTime")
    schema: StructType = stream.schema
    return held.select("shard", "flush", F.from_json("row", schema, AS_TEXT).alias("row")).select("shard", "flush", "row.*")


def flushing(
    stream: DataFrame, policy: FlushPolicy, folder: str, checkpoint: str, every: str = "1 second", once: bool = False, shards: int | None = None, order: str | None = None,
    key: str | None = None, consume: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Batches of the stream, appended to folder/out as parquet with shard and flush, each row once; or given to consume with the micro-batch's number, which is given again if the process ends before its commit.

    What is held when the query ends stays in its checkpoint, and is passed on by the next query on it, or by drain().
    """
    spark = stream.sparkSession
    append_text(spark, f"{folder}/marks/.none", "")  # the folder is there
    marks = spark.readStream.text(f"{folder}/marks").select(F.lit(None).cast("int").alias("shard"))
    out = batches(stream, policy, shards, order, marks, key)
    writer = out.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.foreachBatch(lambda df, k: consume(df, k)) if consume else writer.format("parquet").option("path", f"{folder}/out")
    # a query takes the session's settings as they are when it starts. Timers ask for batches without rows for ever; one to the present end has none
    own = {"spark.sql.streaming.stateStore.providerClass": PROVIDER} | ({"spark.sql.streaming.noDataMicroBatches.enabled": "false"} if once else {})
    before = {name: spark.conf.get(name) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def drain(stream: DataFrame, policy: FlushPolicy, folder: str, checkpoint: str, **options) -> None:
    """Runs flushing() to the stream's present end and passes on what is then held: a mark goes through the stream, so it too counts once."""
    flushing(stream, policy, folder, checkpoint, once=True, **options).awaitTermination()
    append_text(stream.sparkSession, f"{folder}/marks/{uuid.uuid4().hex}.txt", "all\n")
    flushing(stream, policy, folder, checkpoint, once=True, **options).awaitTermination()


def flushed(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """What flushing() has passed on. schema: that of the stream, which alone tells the columns while nothing has gone out."""
    read = spark.read if schema is None else spark.read.schema(StructType([StructField("shard", IntegerType()), StructField("flush", LongType()), *(StructField(f.name, f.dataType) for f in schema.fields)]))
    return read.parquet(f"{folder}/out")
