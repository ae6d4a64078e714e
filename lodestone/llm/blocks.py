"""Blocks of documents and packed exchanges between blocks and buckets.

An operator over all n-grams, anchors or windows of a corpus would shuffle many times the text if each took a row. Here a
block of documents (about BLOCK bytes of text, compressed, one row) sends each bucket one packed array of its distinct
keys, already combined within the block, and a bucket answers each block in the order in which it asked. A key that is
in a third of all documents is thus sent once by each block, however often it occurs, and nothing is collected anywhere.

Blocks are a checkpoint, so later passes see the same blocks even if executors are lost in between.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, ensure_checkpoint_dir, give_back, shuffle_parts, text_bytes, tidy

BLOCK = 5 << 20  # bytes of text; a longer text is a block of its own
BUCKET = 32 << 20  # bytes of text for each bucket of an exchange

NO_ID = (1 << 63) - 1  # what a null id counts as, where ids have an order

SCHEMA = "block long, ids binary, offsets binary, texts binary, bytes long, rest binary"
SENT = "bucket long, block long, payload binary"
ANSWER = "block long, bucket long, payload binary"


def squeeze(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed byte planes, each with no more bytes than its largest value needs; arrays of bytes stay such."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        if a.dtype == np.uint8:
            body = zstandard.compress(a.tobytes(), 3)
            out.append(np.array([len(a), 0, len(body)], "<u8").tobytes() + body)
            continue
        wide = a.astype("<u8") if a.dtype != np.uint64 else a
        width = max(1, -(-int(wide.max(initial=0)).bit_length() // 8))
        planes = wide.view(np.uint8).reshape(-1, 8)[:, :width].T
        body = zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)
        out.append(np.array([len(a), width, len(body)], "<u8").tobytes() + body)
    return b"".join(out)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    """The arrays of squeeze(), as unsigned 64-bit integers or as bytes."""
    out, at = [], 0
    while at < len(data):
        n, width, size = (int(x) for x in np.frombuffer(data, "<u8", 3, at))
        body = zstandard.decompress(data[at + 24 : at + 24 + size], max_output_size=max(1, n * max(1, width)))
        if width:
            planes = np.zeros((n, 8), np.uint8)
            planes[:, :width] = np.frombuffer(body, np.uint8).reshape(width, n).T
            out.append(planes.view("<u8").ravel())
        else:
            out.append(np.frombuffer(body, np.uint8))
        at += 24 + size
    return out


def make_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), scale: float = 1.0, pack: Callable[[np.ndarray, np.ndarray], bytes] | None = None) -> DataFrame:
    """A checkpoint of blocks of about scale * BLOCK bytes. Null texts are empty; rows keep their order within a block, and the carried columns with them.

    pack: what is kept of the texts, from their bytes and offsets, each text followed by a line feed; else they are compressed as they are.
    """
    most = int(BLOCK * scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            data, offsets = text_bytes(rows.column(1), b"\n" if pack else b"")
            body = pack(data, offsets) if pack else zstandard.compress(data.tobytes(), 6)
            ids = pc.fill_null(rows.column(0), NO_ID).to_numpy(zero_copy_only=False)
            null = pc.is_null(rows.column(0)).to_numpy(zero_copy_only=False)
            number += 1
            packed = [pa.array([x], pa.binary()) for x in (ids.tobytes() + null.tobytes(), offsets.astype(np.int64).tobytes(), body)]
            rest = None
            if carry:
                with pa.BufferOutputStream() as sink, pa.ipc.new_stream(sink, (others := rows.select(range(2, rows.num_columns))).schema) as out:
                    out.write_batch(others)
                rest = zstandard.compress(sink.getvalue().to_pybytes(), 3)
            return pa.RecordBatch.from_arrays([pa.array([number]), *packed, pa.array([len(data)], pa.int64()), pa.array([rest], pa.binary())], ["block", "ids", "offsets", "texts", "bytes", "rest"])

        for batch in batches:
            _, offsets = text_bytes(batch.column(1), b"")
            row = 0
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most - size, "right")) - 1)
                held.append(batch.slice(row, end - row))
                size += int(offsets[end] - offsets[row])
                row = end
                if size >= most * 3 // 4:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    ensure_checkpoint_dir(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    chosen = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *[docs[c].alias(f"carry{i}") for i, c in enumerate(carry)])
    return chosen.mapInArrow(tidy(run), SCHEMA).checkpoint()


def opened(row: dict, pad: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's ids (null: NO_ID), its texts in one buffer, each followed by pad, and their offsets (n + 1, of the padded texts)."""
    offsets = np.frombuffer(row["offsets"], np.int64)
    ids = np.frombuffer(row["ids"], np.int64, len(offsets) - 1)
    texts = zstandard.decompress(row["texts"], max_output_size=max(1, int(offsets[-1])))
    data = pad.join([texts[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]) + pad
    return ids, np.frombuffer(data, np.uint8), offsets + len(pad) * np.arange(len(offsets))


def carried(row: dict) -> list[pa.Array]:
    """The carried columns of a block."""
    table = pa.ipc.open_stream(zstandard.decompress(row["rest"], max_output_size=1 << 31)).read_all()
    return [c.combine_chunks() for c in table.columns]


def nulls(row: dict) -> np.ndarray:
    """Which ids of a block are null."""
    n = len(row["offsets"]) // 8 - 1
    return np.frombuffer(row["ids"], bool, n, 8 * n)


def id_column(row: dict) -> pa.Array:
    ids = np.frombuffer(row["ids"], np.int64, len(row["offsets"]) // 8 - 1)
    return pa.array(ids, mask=nulls(row))


def ranked(ids: np.ndarray) -> np.ndarray:
    """Ids as unsigned integers of the same order."""
    return ids.view(np.uint64) ^ np.uint64(1 << 63)


def route(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit hash: equal ranges, so ascending hashes have ascending buckets."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bucket_count(blocks: DataFrame) -> int:
    total = blocks.agg({"bytes": "sum"}).first()[0] or 0
    return max(shuffle_parts(blocks.sparkSession), -(-total // BUCKET))


def split(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Runs of an array of ascending bucket numbers."""
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for k in range(buckets):
        if cuts[k] < cuts[k + 1]:
            yield k, slice(int(cuts[k]), int(cuts[k + 1]))


def send(blocks: DataFrame, run, schema: str = SENT) -> DataFrame:
    """run(block row) gives (bucket, payload)s; map-only."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield packed(((b, row["block"], p) for b, p in run(row)), ("bucket", "block"))
                give_back()

    return blocks.mapInArrow(over, schema)


def packed(rows, names: tuple[str, str]) -> pa.RecordBatch:
    rows = list(rows)
    a, b, p = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(p, pa.binary())], [*names, "payload"])


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Within it, an action's shuffle files are removed once it has ended; what it read must be there to be read again, as checkpoints are."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def answer(spark: SparkSession, sent, buckets: int, run) -> DataFrame:
    """run(bucket, [(block, arrays)]) gives (block, payload)s. A checkpoint: what sent() gave, held nowhere else, is free again."""

    def over(key: tuple, rows: pa.Table) -> pa.Table:
        asked = [(r["block"], unsqueeze(r["payload"])) for r in rows.to_pylist()]
        bucket = key[0].as_py()
        out = [(block, bucket, p) for block, p in run(bucket, sorted(asked, key=lambda x: x[0]))]
        a, b, p = zip(*out, strict=True) if out else ((), (), ())
        del asked, out
        give_back()
        return pa.table({"block": pa.array(a, pa.int64()), "bucket": pa.array(b, pa.int64()), "payload": pa.array(p, pa.binary())})

    with freeing(spark):
        return sent().repartition(buckets, "bucket").groupBy("bucket").applyInArrow(over, ANSWER).checkpoint()


def rejoin(blocks: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """run(block row, {bucket: [arrays]}) for each block with what buckets answered; gives a table."""

    def over(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[int, list] = {}
        for r in right.to_pylist():
            got.setdefault(r["bucket"], []).append(unsqueeze(r["payload"]))
        parts = [run(row, got) for row in left.to_pylist()]
        del got
        give_back()
        return pa.concat_tables(parts) if parts else run(None, {})

    parts = max(shuffle_parts(blocks.sparkSession), blocks.count() // 2)
    return blocks.repartition(parts, "block").groupBy("block").cogroup(answers.repartition(parts, "block").groupBy("block")).applyInArrow(over, schema)
