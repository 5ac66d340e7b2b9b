"""From raw documents to token ids: quality rules, line dedup, near-dedup, source mixing, SentencePiece.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and works on all rows
that its predecessor kept. ``run`` writes every stage's rows to the shared scratch folder and reads them
back for the next. All stages but the last return the columns they were given, those of ``documents``.

Null and empty texts fail the quality rules; later stages meet empty texts only where line dedup dropped
every line, and keep them. Extra columns travel along untouched, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.llm import line_dedup, minhash_dedup, mixing, quality, sentencepiece_codec
from brandpulse.llm.common import id_key, scratch
from brandpulse.llm.queries import piece_model

ID, TEXT, SOURCE = "doc_id", "text", "source"


def _packed(docs: DataFrame) -> DataFrame:
    """Id and text, and all else in one column, so that no name can clash with an operator's."""
    return docs.select(ID, TEXT, F.struct(*[F.col(c) for c in docs.columns if c != TEXT]).alias("_row"))


def _unpacked(out: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    return out.select(*[(changed[c] if c in changed else F.col(TEXT) if c == TEXT else F.col("_row")[c]).alias(c)
                        for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality.quality_rules(_packed(docs), labels, ID, TEXT, ["_row"])
    return _unpacked(out.where("kept"), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share stay in the last of them; ``n_chars`` follows the text."""
    out = line_dedup.line_dedup(_packed(docs), ID, TEXT, ["_row"])
    more = {"n_chars": F.char_length(TEXT).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return _unpacked(out, docs, **more)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id, of several the one with the
    smallest hash of its text, and of repeated rows one. Texts without words are in no group and stay."""
    groups = minhash_dedup.minhash_dedup(docs, ID, TEXT).withColumn("_d", id_key(ID))
    chosen = (groups.where("_group IS NOT NULL").groupBy("_group").agg(F.min(F.struct("_d", "_h")).alias("row")).select("row.*")
              .unionByName(groups.where("_group IS NULL").select("_d", "_h").distinct().withColumn("_every", F.lit(True)), True))
    named = docs.select(F.struct("*").alias("_row"), id_key(ID).alias("_d"),
                        F.xxhash64(F.coalesce(F.col(TEXT), F.lit(""))).alias("_h"))
    kept = named.join(chosen, ["_d", "_h"]).withColumn("_alone", F.when(F.col("_every"), F.monotonically_increasing_id()))
    return kept.dropDuplicates(["_d", "_h", "_alone"]).select("_row.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.apply_mix(docs, mixing.mix_sources(docs, ID, TEXT, SOURCE), ID, TEXT, SOURCE)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    path = piece_model()
    out = sentencepiece_codec.sentencepiece_encode(docs, path, ID, TEXT, [SOURCE])
    return (sentencepiece_codec.sentencepiece_decode(out.drop(TEXT), path)
            .select(ID, SOURCE, F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("minhash_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: The forest, the near-duplicate groups, the rounding and the tokenizer cannot be stated in SQL; the pipeline is
#: tested against plain Python in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
