"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within RADIUS bits have a common variant within half the radius of each. A full-width ball of radius 2
holds 1 + 64 + 2016 = 2081 variants, which for each fingerprint is several times the text it stands for. So balls are
taken on projections: of three bands of bits, some two hold at most 2 of the 4 differing bits (4 * 2 / 3, rounded
down), so on that pair of bands, about 43 bits wide, balls of radius 1 meet. Each distinct fingerprint emits 3 * (1 + 43)
variants; nothing is missed, and every colliding pair is verified on all 64 bits.

Copies are collapsed to distinct fingerprints first. Variants travel as packed blocks, one row for each map task and
bucket, so no key is hot in the shuffle; within a bucket, fingerprints with a common variant are linked by a search that
visits each once and compares it with those not yet reached only, and gives a spanning forest, never all pairs.

Cases: null, empty and blank texts have fingerprint zero and link like any other. Repeated rows stay; rows of one id but
different texts are not linked by it. A null id names a component only if it has no other, and then as null. Texts of fewer than
four words are one shingle. Further columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, ensure_checkpoint_dir, first_of_runs, give_back, mix, shuffle_parts, tidy
from .graph import MANY, components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Bands as bit ranges, and the pairs of bands that are keys.
BANDS = ((0, 21), (21, 42), (42, 64))
PAIRS = ((0, 1), (0, 2), (1, 2))


def fingerprint(text: str) -> int:
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the contract's white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[: len(starts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit integer, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or "") for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), "doc_id long, fp long")


def _masks(pair: tuple[int, int]) -> tuple[np.uint64, np.ndarray]:
    bits = [b for k in pair for b in range(*BANDS[k])]
    return np.uint64(sum(1 << b for b in bits)), np.array([0, *(1 << b for b in bits)], np.uint64)


def balls(fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each pair of bands: its number, the variants (kept bits of each fingerprint, one flipped or none), and whose they are."""
    for number, pair in enumerate(PAIRS):
        keep, flips = _masks(pair)
        yield number, ((fps & keep)[:, None] ^ flips).ravel(), np.repeat(fps, len(flips))


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints."""
    out, rest = [], fps
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= RADIUS
            front.extend(rest[near])
            out += [(x, y) for y in rest[near]]
            rest = rest[~near]
    return out


def _emit(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.unique(batch.column(0).to_numpy().view(np.uint64))
            for at in range(0, len(fps), 4096):
                for number, variants, owner in balls(fps[at : at + 4096]):
                    bucket = (mix(variants ^ np.uint64(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))
                    rows = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(bucket[r[0]]) for r in rows], pa.int64()),
                            pa.array([number] * len(rows), pa.int32()),
                            pa.array([variants[r].tobytes() for r in rows], pa.binary()),
                            pa.array([owner[r].tobytes() for r in rows], pa.binary()),
                        ],
                        ["bucket", "number", "variants", "owners"],
                    )

    return run


def _link(rows: pd.DataFrame) -> pd.DataFrame:
    edges = set()
    for _, group in rows.groupby("number"):
        variants = np.frombuffer(b"".join(group.variants), np.uint64)
        owners = np.frombuffer(b"".join(group.owners), np.uint64)
        order = np.lexsort((owners, variants))
        variants, owners = variants[order], owners[order]
        new = first_of_runs(variants) | first_of_runs(owners)
        variants, owners = variants[new], owners[new]
        cuts = np.append(np.flatnonzero(first_of_runs(variants)), len(variants))
        for k in np.flatnonzero(np.diff(cuts) > 1):
            edges.update(forest(owners[cuts[k] : cuts[k + 1]]))
    give_back()
    out = np.array(list(edges), np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all links."""
    # about 130 variants of 16 bytes for each fingerprint; a bucket stays near 2 million variants at any size
    buckets = max(shuffle_parts(distinct.sparkSession), -(-distinct.count() * 130 // 2_000_000))
    sent = distinct.select("fp").mapInArrow(tidy(_emit(buckets)), "bucket long, number int, variants binary, owners binary")
    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links, of each row."""
    ensure_checkpoint_dir(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    prints = fingerprints(docs, id_col, text_col).checkpoint()
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).checkpoint()
    parts = components(links(distinct).checkpoint(), distinct.select(F.col("fp").alias("node"), F.col("first").alias("value")))
    named = distinct.join(parts.select(F.col("node").alias("fp"), "value"), "fp", "left").select("fp", "n", F.coalesce("value", "first").alias("component_id")).checkpoint()
    # fingerprints of very many rows, at most MANY of them, are sent to the rows; the rest meet their rows by a join
    often = max(64, (distinct.agg(F.sum("n")).first()[0] or 0) // MANY)
    hot, rest = named.where(F.col("n") > often).drop("n"), named.where(F.col("n") <= often).drop("n")
    found = prints.join(F.broadcast(hot), "fp").unionByName(prints.join(F.broadcast(hot), "fp", "left_anti").join(rest, "fp"))
    return found.select("doc_id", "fp", "component_id")


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
