"""Plan properties the scale design relies on (checked on the physical plans)."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF01


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _filter_conditions(plan: str) -> list[str]:
    out = []
    for block in plan.split("\n\n"):
        if re.match(r"\(\d+\) Filter", block.strip()):
            out += [line for line in block.split("\n") if line.startswith("Condition")]
    return out


SINGLE_PLAN = ["ascii_strip", "rt_strip", "normalize_text", "tokenize", "json_field", "record_text", "json_encode",
               "drop_null_text", "drop_null_text_compat", "term_list", "safe_name", "dedup_counts", "head_rows",
               "mentions_per", "mentions_last", "mentions_distinct", "score_per", "score_last", "score_distinct",
               "rank_entities", "predictions_table", "hash_split", "label_split", "serialize_labeled", "parse_labeled",
               "train_tokens", "upsert_latest", "linear_predict", "error_rate", "mentions_table", "doc_vector",
               "head_json", "brand_scores_rule", "brand_predictions_rule"]


@pytest.mark.parametrize("name", SINGLE_PLAN)
def test_no_costly_expression_in_a_filter(spark, name):
    """Text cleaning / JSON parsing never sits in a Filter (it would run twice after pushdown)."""
    import __spark_entry__ as E

    plan = _plan(E.queries()[name](spark, SF01))
    for cond in _filter_conditions(plan):
        assert not re.search(r"regexp_replace|from_json|translate|parse_json", cond), (name, cond[:200])


def test_columns_pruned_and_labels_broadcast(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["score_per"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_term_table_broadcast_only_under_bound(spark):
    from brandpulse.functions.text import clean_text_tokens
    from brandpulse.operators.mentions import explode_mentions_join

    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", clean_text_tokens("text").alias("t"))
    terms = spark.createDataFrame([("that",), ("with",)], "term string")
    # Switch off Catalyst's own size-based broadcast so only our checked hint decides.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = _plan(explode_mentions_join(docs, "t", terms))
        big = _plan(explode_mentions_join(docs, "t", terms, max_broadcast_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in small
    assert "SortMergeJoin" in big or "ShuffledHashJoin" in big


def test_hot_key_aggregates_are_partial(spark):
    """Repeat counts, scores and the keyed merge combine map-side before the shuffle."""
    import __spark_entry__ as E

    for name in ["dedup_counts", "score_per", "upsert_latest"]:
        plan = _plan(E.queries()[name](spark, SF01))
        assert re.search(r"partial_(count|sum|max_by)", plan), name


def test_partitioned_sink_is_rebalanced(spark):
    from brandpulse.sinks.writers import _shape

    df = spark.range(10).select(F.lit("klm").alias("airline"), "id")
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(_shape(df, None, False, ["airline"]))


def test_read_table_partitions_are_an_argument(spark):
    from brandpulse.sources.readers import read_table

    assert read_table(spark, SF01, "documents", "doc_id").rdd.getNumPartitions() == 1
    assert read_table(spark, SF01, "documents", "doc_id", partitions=6).rdd.getNumPartitions() == 6


def test_scoring_moves_no_array_after_the_token_join(spark):
    from brandpulse.operators.model import token_margins

    df = spark.createDataFrame([(["a", "b"],)], "comment array<string>")
    words = spark.createDataFrame([("a", 1.0)], "_w string, _s double")
    toks = token_margins(df, "comment", words, 0.0)
    for node in re.findall(r"Exchange hashpartitioning\(_k[^\n]*", toks._jdf.queryExecution().toString()):
        assert "array" not in node
    assert "collect_list" not in _plan(toks) and "ArrowEval" not in _plan(toks)


@pytest.mark.parametrize("large_terms", [False, True])
def test_score_mentions_plan_has_no_costly_filter(spark, large_terms):
    from brandpulse.operators.model import fit_sentiment
    from brandpulse.plans.composites import score_mentions, training_rows

    reviews = spark.createDataFrame([("great klm flight", "1"), ("rude delta crew", "0")] * 10,
                                    "content string, recommended string")
    model = fit_sentiment(training_rows(reviews).drop("split"), vector_size=4, iterations=3, seed=1)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    msgs = docs.select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    terms = spark.createDataFrame([("that",), ("with",)], "term string")
    res = score_mentions(msgs, None, terms, model=model, run_id="r", max_inline_terms=0 if large_terms else 10_000)
    for df in (res.predictions, res.scores):
        for cond in _filter_conditions(_plan(df)):
            assert not re.search(r"regexp_replace|from_json|translate|parse_json", cond), cond[:200]
