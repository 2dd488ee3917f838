"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm import binary, decontaminate, hardnegatives, licences, linededup, mixture, oph, ownership, parityjoin, simhash, suffixes, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_query
def op2_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = mixture.pack(_table(spark, folder, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "queue")


@_query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.classes(_table(spark, folder, "documents")).drop("text_key")


@_query
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    both = oph.with_edited(_table(spark, folder, "documents"))
    near = [oph.likeness("fp", other).alias(name) for other, name in (("edited_fp", "near_edited"), ("next_fp", "near_next"))]
    return both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), oph.hexed("fp").alias("fingerprint"), oph.hexed("edited_fp").alias("edited_fingerprint"), *near)


@_query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, folder, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op6_binary_packing(spark: SparkSession, folder: str) -> DataFrame:
    return binary.pack(_table(spark, folder, "documents"))


@_query
def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.matches(_table(spark, folder, "documents"))


@_query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeats(_table(spark, folder, "documents"))


@_query
def op10_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    found = ownership.scan(_table(spark, folder, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in ownership.KINDS]
    return found.select("doc_id", *counts, F.sha2(ownership.joined("base").cast("binary"), 256).alias("base_sha256"), ownership.joined("spans").alias("spans"), "live", "copied", "repositories", "owners")


@_query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hardnegatives.mined(moved, F.col("vec_id") % 50 == 0)


TWINS["op11_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.label AS other, b.vec_id AS id, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own = other QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
  n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND own <> other AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@_query
def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return parityjoin.linked(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


TWINS["op12_ngram_join"] = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
  g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM d),
  s AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM g),
  l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
  r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, len(g) AS n_shingles, least(doc_id, (SELECT min(b) FROM r WHERE r.a = g.doc_id)) AS component_id FROM g
"""


@_query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    made = whitening.whitened(_table(spark, folder, "embeddings"))
    # exact in 38 digits; what a long can't hold is null
    return made.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
