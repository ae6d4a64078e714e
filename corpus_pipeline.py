"""From raw documents to packed token sequences: five stages, each one operator over all that the stage before kept.

Rows of one doc_id stand or fall together in the first two stages. Texts are whole throughout.

Cases, in every stage: a null text counts as empty, and the PII and repeats stages return it as empty. A null doc_id is an id of
its own: rows of it are kept if any of them is, and they come last where ids have an order. Repeated rows stay repeated
rows, but for the near-duplicate stage, whose groups are of fingerprints, so that repeated rows of the id that stays all
stay. Ties go to the smaller id. An empty table gives an empty table; no or one-sided labels keep every document. Further
columns, also those that clash with an operator's own, are not read and not returned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import ensure_checkpoint_dir
from lodestone.llm.packing import harmonic_pack
from lodestone.llm.pii import find_pii, mask
from lodestone.llm.queries import table, tokenizer_path
from lodestone.llm.simhash import near_duplicates
from lodestone.llm.site_quality import site_quality
from lodestone.llm.suffix_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is among ids (null is an id of its own)."""
    ids = ids.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(ids, docs.doc_id.eqNullSafe(ids.kept_id), "left_semi").select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier rejects go."""
    return _with_ids(docs, site_quality(docs, table(spark, sf_dir, "labels")).where("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates stays."""
    return _with_ids(docs, near_duplicates(docs).where("doc_id <=> component_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id holds are cut out; letters that a cut leaves in part go too."""
    cut = remove_repeats(docs, texts=True, carry=("lang", "source"))
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets."""
    found = find_pii(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    masked = found.withColumn("text", mask(F.col("text"), F.col("pii"))).drop("pii")
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences."""
    return harmonic_pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("PII", mask_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None  # a fitted classifier and fingerprints are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str, keep: bool = False) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again. What no later stage reads is deleted, unless it is to be kept."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k and not keep:
                old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
                old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return docs
