"""Registered queries over the tables of documents, labels and pages, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import decode, encode
from .class_model import score_documents
from .exact_names import exact_dedup, normalised
from .filter_audit import audit
from .language import identify
from .near_dedup import near_dedup
from .packing import pack
from .quality_rank import rank_quality
from .quality_rules import quality_rules
from .repeats import remove_repeats
from .site_tree import extract
from .toxicity import score_toxicity
from .vector_codes import compress


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(_read(spark, folder, "documents"))


def op2_bradley_terry(spark: SparkSession, folder: str) -> DataFrame:
    return rank_quality(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op3_pow2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_read(spark, folder, "documents")).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op4_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return identify(_read(spark, folder, "documents"))


def op5_interval_tree(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_read(spark, folder, "documents")).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op6_block_names(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").withColumn("text_sha256", F.sha2(normalised(F.col("text")).cast("binary"), 256))
    return exact_dedup(docs, carry=["text_sha256"])


def op7_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_read(spark, folder, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op8_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return extract(_read(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_block_max(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op10_bpe_rounds(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode(encode(_read(spark, folder, "documents")))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(_read(spark, folder, "documents"))


def op12_potential(spark: SparkSession, folder: str) -> DataFrame:
    return audit(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op13_equal_average(spark: SparkSession, folder: str) -> DataFrame:
    return compress(_read(spark, folder, "embeddings"))


def _codes_sql(rounds: int = 4) -> str:
    """Plain search over all entries; each round adds an assignment and the entries that follow from it."""
    assign = """
a{r} AS MATERIALIZED (
  SELECT p.rn, p.part, any_value(p.x) AS x, min(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x)) AS best,
    (min((list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x))::BIGINT * 256 + c.entry) % 256)::INT AS code
  FROM parts p JOIN c{r} c USING (part) GROUP BY p.rn, p.part
)"""
    move = """
m{r} AS MATERIALIZED (
  SELECT part, code AS entry, pos, sum(x[pos]::BIGINT) AS s, count(*) AS n FROM a{r}, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16]) AS pos) GROUP BY ALL
), c{next} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(n.x, c.x) AS x FROM c{r} c
  LEFT JOIN (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY pos) AS x FROM m{r} GROUP BY ALL) n USING (part, entry)
)"""
    steps = ",".join(assign.format(r=r) + "," + move.format(r=r, next=r + 1) for r in range(rounds)) + "," + assign.format(r=rounds)
    return f"""
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0
), parts AS MATERIALIZED (
  SELECT rn, part, v[part * 16 + 1:part * 16 + 16] AS x FROM rows, (SELECT unnest([0, 1, 2, 3]) AS part)
), c0 AS MATERIALIZED (SELECT part, (rn - 1)::INT AS entry, x FROM parts WHERE rn <= 256),{steps}
, codes AS (
  SELECT rn, string_agg(printf('%02x', code), '' ORDER BY part) AS code, sum(best)::BIGINT AS error FROM a{rounds} GROUP BY rn
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: v::BIGINT), ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM rows JOIN codes USING (rn)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_bradley_terry": op2_bradley_terry,
    "op3_pow2_packing": op3_pow2_packing,
    "op4_mixture": op4_mixture,
    "op5_interval_tree": op5_interval_tree,
    "op6_block_names": op6_block_names,
    "op7_weak_rules": op7_weak_rules,
    "op8_style_tree": op8_style_tree,
    "op9_block_max": op9_block_max,
    "op10_bpe_rounds": op10_bpe_rounds,
    "op11_class_ngrams": op11_class_ngrams,
    "op12_potential": op12_potential,
    "op13_equal_average": op13_equal_average,
}

ORACLE: dict[str, str] = {
    "op6_block_names": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept,
  sha256(t) AS text_sha256
FROM n
WINDOW w AS (PARTITION BY t ORDER BY chars DESC, doc_id)
""",
    # Each step of each order is played out on the documents' failures; the query plays coalitions instead.
    "op12_potential": r"""
WITH told AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), docs AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents d LEFT JOIN told USING (doc_id)
), fails AS (
  SELECT part, good, toxic, [
    len(words) < 100,
    100 * len(list_distinct(words)) < 80 * len(words),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)
  ] AS f FROM docs
), cells AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) AS l(letter, i)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS players
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT filter_order, players, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), played AS (
  SELECT part, filter_order, step, n, good, toxic, f[players[step]] AS fails,
    len(list_filter(players[1:step - 1], lambda p: f[p])) > 0 AS gone,
    len(list_filter([1, 2, 3, 4, 5], lambda p: f[p])) = 1 AS alone, players[step] AS player
  FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, player,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone AND fails THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM played GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, player))::BIGINT AS shapley
FROM counted
""",
    "op13_equal_average": _codes_sql(),
}
