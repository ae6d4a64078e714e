"""The registered queries of the training-data operators, their SQL where SQL can express them, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchor_dedup import remove_passages
from .katz import katz_scores
from .packing import harmonic_pack
from .phrases import collocations
from .pii import pii_digest
from .quality_rules import repetition_quality
from .ranking import leading_rows
from .sentencepieces import piece_round_trip
from .simhash import near_duplicate_digest
from .site_quality import site_quality
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .topk import top_k


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_quality(table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(vectors.vec_id % 20 == 0))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_digest(table(spark, sf_dir, "documents"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))


def op8_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic_pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS k FROM w),
f AS (
  SELECT lang, size, array_to_string(w[k:k + size - 1], ' ') AS phrase, count(*) AS c
  FROM s, (SELECT unnest(range(1, 6)) AS size) WHERE k + size - 1 <= len(w) GROUP BY ALL),
c AS (SELECT lang, phrase, size, c AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND c >= 100),
i AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[1:size - 1], ' ') AS phrase FROM c UNION ALL SELECT lang, a, array_to_string(w[2:size], ' ') FROM c) GROUP BY ALL),
k AS (SELECT c.*, unnest(range(1, size)) AS k FROM c LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
t AS (SELECT lang, sum(c) AS n FROM f WHERE size = 1 GROUP BY lang),
x AS (
  SELECT k.lang, k.phrase, k, a, l.c AS l, r.c AS r, t.n, CAST(1000 AS HUGEINT) * a * t.n // (CAST(l.c AS HUGEINT) * r.c) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(w[k + 1:k.size], ' ')
  JOIN t ON t.lang = k.lang),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM y)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM z WHERE rank <= 2000
"""


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "sale_lines")

    def whole(x):  # not a number, or beyond what a double holds exactly: null
        return F.when(F.abs(x) < 2.0**53, F.floor(x))

    one = F.coalesce(F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    month = 100 * F.year("shipped_at") + F.month("shipped_at")
    lines = lines.select(
        F.when(one, F.lit(-1)).otherwise(F.col("vendor_id")).alias("vendor_id"),
        F.when(one, F.lit(-1)).otherwise(F.coalesce(F.pmod("item_id", F.lit(5)), F.lit(-1))).alias("part"),
        F.when(one, F.lit(-1)).otherwise(F.coalesce(month, F.lit(-1))).alias("month"),
        F.floor(F.col("quantity") / 10).alias("tens"),
        whole(100 * F.col("discount") + 0.5).alias("percent"),
        "sale_id",
        "line_no",
        "quantity",
        whole(100 * F.col("amount") + 0.5).alias("amount_cents"),
    )
    found = leading_rows(lines, ("vendor_id", "part", "month"), (("tens", True), ("percent", False)), ("sale_id", "line_no", "quantity", "amount_cents"), 2)
    return found.select("vendor_id", "part", "month", "pos", F.col("pos").alias("place"), "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")


#: crc32 of a decimal text, bit by bit: a code is added, or (for -1) one bit is shifted out.
OP12_SQL = """
WITH c AS (
  SELECT sale_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(sale_id AS VARCHAR), ''),
    lambda d: list_prepend(CAST(ascii(d) AS BIGINT), list_transform(range(8), lambda i: CAST(-1 AS BIGINT)))))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END), 4294967295) AS crc
  FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL)),
l AS (
  SELECT coalesce(crc % 5 = 0, FALSE) AS one, s.*, CAST(floor(s.quantity / 10.0) AS BIGINT) AS tens,
    CAST(CASE WHEN abs(discount * 100 + 0.5) < 9007199254740992 THEN floor(100 * discount + 0.5) END AS BIGINT) AS percent,
    CAST(CASE WHEN abs(amount * 100 + 0.5) < 9007199254740992 THEN floor(100 * amount + 0.5) END AS BIGINT) AS amount_cents
  FROM sale_lines s LEFT JOIN c USING (sale_id)),
g AS (
  SELECT CASE WHEN one THEN -1 ELSE vendor_id END AS vendor_id,
    CASE WHEN one THEN -1 ELSE coalesce((item_id % 5 + 5) % 5, -1) END AS part,
    CASE WHEN one THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS month,
    tens, percent, sale_id, line_no, quantity, amount_cents FROM l),
r AS (
  SELECT *, row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST,
    sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
    count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied FROM g)
SELECT CAST(vendor_id AS BIGINT) AS vendor_id, CAST(part AS BIGINT) AS part, CAST(month AS BIGINT) AS month, CAST(pos AS BIGINT) AS pos,
  CAST(pos AS BIGINT) AS place, sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity, percent, amount_cents,
  CAST(tied AS BIGINT) AS tied FROM r WHERE pos <= 2
"""


def op13_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT rn, id, w, unnest(range(1, len(w) - 11)) AS k FROM d),
g AS (SELECT rn, id, k, array_to_string(w[k:k + 12], ' ') AS words FROM s),
f AS (SELECT words, min(id) AS least FROM g GROUP BY words),
x AS (SELECT DISTINCT rn, k + unnest(range(0, 13)) AS p FROM g JOIN f USING (words) WHERE least < id),
u AS (SELECT rn, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT u.rn, string_agg(word, ' ' ORDER BY u.p) AS kept, count(*) AS n FROM u ANTI JOIN x ON u.rn = x.rn AND u.p = x.p GROUP BY u.rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rn)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_topk, op3_token_counts, op4_pii, op5_suffix_dedup, op6_simhash, op7_katz, op8_sentencepieces, op9_site_quality, op10_packing, op11_phrases, op12_ranking, op13_anchor_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": OP2_SQL, "op11_phrases": OP11_SQL, "op12_ranking": OP12_SQL, "op13_anchor_dedup": OP13_SQL}
