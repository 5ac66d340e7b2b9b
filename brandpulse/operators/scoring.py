"""Repeat counting, per-entity scores, ranking and error rates.

All aggregations are hash aggregates with a partial (map-side) step, so a key
that holds a third of all rows is pre-combined inside each task before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brandpulse.session import scratch_path


def count_repeats(df: DataFrame, text_col: str = "text", extra_keys: list[str] | None = None) -> DataFrame:
    """A1 + F12: one row per distinct text with ``n`` (copies) and ``retweets`` (n - 1).

    ``extra_keys`` are columns that are functions of the text (e.g. its matched
    terms); grouping by them too carries them through the shuffle without a
    second pass and without a non-hashable aggregate buffer.
    """
    keys = [text_col] + list(extra_keys or [])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("retweets", F.col("n") - F.lit(1))
    )


def score_entities(mentions: DataFrame, entity_col: str = "term", prediction_col: str = "prediction",
                   out_entity: str | None = None) -> DataFrame:
    """A2 + A3 + F13: per entity ``positive_comments``, ``total_comments`` and their ratio.

    Each mention row weighs 1 whatever its text's repeat count (as the reference).
    Counts are BIGINT: at full scale they pass 2^31. ``score`` is DOUBLE (T11).
    """
    name = out_entity or entity_col
    return (
        mentions.groupBy(F.col(entity_col).alias(name))
        .agg(
            F.sum(F.col(prediction_col).cast("bigint")).alias("positive_comments"),
            F.count(F.lit(1)).alias("total_comments"),
        )
        .select(
            name,
            F.try_divide(F.col("positive_comments").cast("double"), F.col("total_comments")).alias("score"),
            "total_comments",
            "positive_comments",
        )
    )


def rank_entities(scores: DataFrame, entity_col: str = "term", min_comments: int = 0,
                  top_k: int | None = None) -> DataFrame:
    """Rank entities by score (highest first), ties share a rank.

    Ranks come from the distinct scores, each with its number of entities (a pre-aggregated shuffle), in range
    partitions: a range is summed down on its own, the sums of the ranges before it are added, and an entity's rank
    is one more than the entities above its score. The ranges are written once, so both steps see the same;
    what meets in one place is one number for each range. ``top_k`` first finds the k-th best score by a top-k plan
    and drops what lies below it.
    """
    spark = scores.sparkSession
    kept = scores.where(F.col("total_comments") >= F.lit(min_comments))
    if top_k is not None:
        least = (kept.select("score").orderBy(F.col("score").desc_nulls_last()).limit(top_k)
                 .agg(F.min(F.coalesce("score", F.lit(float("-inf")))).alias("_least")))
        kept = kept.join(F.broadcast(least), F.coalesce("score", F.lit(float("-inf"))) >= F.col("_least")).drop("_least")
    per = kept.groupBy(F.col("score").alias("_score")).agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, "rank-ranges")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (per.repartitionByRange(ranges, F.col("_score").desc_nulls_last()).withColumn("_range", F.spark_partition_id())
     .write.parquet(path))
    per = spark.read.schema("_score double, _n bigint, _range int").parquet(path)
    counts = dict(map(tuple, per.groupBy("_range").agg(F.sum("_n")).collect()))          # one row a range
    before = [(r, sum(n for q, n in counts.items() if q < r)) for r in counts]
    starts = F.broadcast(spark.createDataFrame(before, "_range int, _before bigint"))
    above = (Window.partitionBy("_range").orderBy(F.col("_score").desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranks = per.withColumn("_upto", F.sum("_n").over(above)).join(starts, "_range").select(
        "_score", (F.col("_before") + F.col("_upto") - F.col("_n") + 1).cast("int").alias("rank"))
    ranked = kept.join(ranks, F.col("score").eqNullSafe(F.col("_score"))).drop("_score")
    return ranked if top_k is None else ranked.where(F.col("rank") <= F.lit(top_k))


def error_rate(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
               group_cols: list[str] | None = None) -> DataFrame:
    """A4 + A5 + W5 (+K8 as a table): ``n``, ``wrong`` and ``error`` in one pass.

    The reference counts twice (misclassified, then all) per split; one
    aggregate does both.
    """
    wrong = F.col(label_col).cast("double") != F.col(prediction_col).cast("double")
    grouped = df.groupBy(*(group_cols or []))
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(wrong).alias("wrong"),
    ).withColumn("error", F.try_divide(F.col("wrong").cast("double"), F.col("n")))
