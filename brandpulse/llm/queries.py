"""Registered queries of the llm operators: each applies its operator to the whole intended table and
derives the contract's columns from the operator's output. ``SQL`` holds DuckDB SQL where SQL can state
the result; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.llm import (
    conversations,
    line_dedup,
    lm_scoring,
    minhash_dedup,
    mixing,
    nbsvm,
    quality,
    sentencepiece_codec,
    substring_dedup,
    suffix_dedup,
    token_counts,
    topk,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@register("op1_line_dedup", r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM rows),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3),
judged AS (SELECT a.r, a.doc_id, a.pos, a.line, c.k IS NOT NULL AND a.doc_id < c.keep AS gone
           FROM keyed a LEFT JOIN common c ON a.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
""")
def op1(spark, sf):
    out = line_dedup.line_dedup(table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@register("op5_quality_rules")
def op5(spark, sf):
    out = quality.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return out.select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


@register("op7_source_mixing")
def op7(spark, sf):
    out = mixing.mix_sources(table(spark, sf, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "source", "copies")


@register("op9_topk_search", """
WITH v AS (SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
""")
def op9(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), lambda i: i % 50 == 0)


@register("op2_suffix_dedup")
def op2(spark, sf):
    out = suffix_dedup.suffix_dedup(table(spark, sf, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed",
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_substring_dedup")
def op4(spark, sf):
    out = substring_dedup.substring_dedup(table(spark, sf, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op3_minhash_dedup")
def op3(spark, sf):
    return minhash_dedup.minhash_dedup(table(spark, sf, "documents")).drop("_h", "_group")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register("op8_sentencepiece")
def op8(spark, sf):
    path = piece_model()
    out = sentencepiece_codec.sentencepiece_decode(
        sentencepiece_codec.sentencepiece_encode(table(spark, sf, "documents"), path), path)
    return out.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                      F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
                      F.sha2("decoded", 256).alias("decoded_sha256"),
                      (F.col("decoded") == F.col("text")).alias("round_trip"))


@register("op10_token_counts")
def op10(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), piece_model())


@register("op6_lm_scoring")
def op6(spark, sf):
    return lm_scoring.lm_scores(table(spark, sf, "documents"), piece_model())


@register("op13_conversation_repair")
def op13(spark, sf):
    return conversations.repair_conversations(table(spark, sf, "conversations"))


@register("op11_embedding_whitening")
def op11(spark, sf):
    out = whitening.whiten(table(spark, sf, "embeddings"))
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return (out.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", one)
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
                    F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error"))


@register("op12_quality_classifier")
def op12(spark, sf):
    return nbsvm.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
