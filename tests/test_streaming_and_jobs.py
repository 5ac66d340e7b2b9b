"""Streaming equals batch; composite jobs (C1 modes, compat ids, join path, runner)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from brandpulse.functions.text import record_text
from brandpulse.operators.model import fit_sentiment
from brandpulse.operators.scoring import count_repeats
from brandpulse.plans.composites import run_score_job, score_mentions
from brandpulse.session import scratch_path
from brandpulse.streaming.ingest import dedup_stream, read_dedup_counts, route_stream, routed_records
from conftest import SF001

TERMS = ["that", "with", "this", "from", "tion", "than"]


def _src(spark, files=5):
    src = scratch_path(spark, "test_src")
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    conv.select(F.to_json(F.struct("conv_id", "turn", "text")).alias("value")).repartition(files).write.text(src)
    return src


def test_route_stream_equals_batch(spark):
    src = _src(spark)
    out, ckpt = scratch_path(spark, "o"), scratch_path(spark, "c")
    route_stream(spark, src, out, ckpt, TERMS, max_files_per_trigger=2).awaitTermination()
    streamed = sorted((r["value"], r["stream"]) for r in spark.read.text(out).collect())
    batch = sorted((r["value"], r["stream"]) for r in routed_records(spark.read.text(src), TERMS).collect())
    assert streamed == batch and len(batch) > 0
    # Restart on the same checkpoint: nothing is written twice.
    route_stream(spark, src, out, ckpt, TERMS).awaitTermination()
    assert spark.read.text(out).count() == len(batch)


def test_dedup_stream_over_several_batches_equals_batch(spark):
    src = _src(spark)
    out, ckpt = scratch_path(spark, "o"), scratch_path(spark, "c")
    dedup_stream(spark, src, out, ckpt, max_files_per_trigger=1).awaitTermination()
    assert spark.read.parquet(out + "/updates").select("batch").distinct().count() > 1

    def want():
        texts = spark.read.text(src).select(record_text("value").alias("text")).where("text IS NOT NULL")
        return sorted(tuple(r) for r in count_repeats(texts, "text").collect())

    assert sorted(tuple(r) for r in read_dedup_counts(spark, out).collect()) == want()
    # More files arrive: a restarted query adds them.
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    conv.select(F.to_json(F.struct("conv_id", "turn", "text")).alias("value")).repartition(2).write.mode("append").text(src)
    dedup_stream(spark, src, out, ckpt, max_files_per_trigger=1, compact_every=3).awaitTermination()
    assert sorted(tuple(r) for r in read_dedup_counts(spark, out).collect()) == want()
    assert spark.read.parquet(out + "/updates").select("batch").distinct().count() < 3     # folded ones have expired


def _msgs(spark, texts):
    return spark.createDataFrame([(json.dumps({"text": t}),) for t in texts], "value string")


def _model(spark):
    reviews = spark.createDataFrame(
        [("great klm flight", "1"), ("rude delta crew", "0")] * 20, "content string, recommended string")
    from brandpulse.plans.composites import training_rows
    return fit_sentiment(training_rows(reviews).drop("split"), vector_size=8, iterations=10, seed=1)


def test_score_mentions_modes_and_compat_ids(spark):
    texts = ["klm vs delta", "RT klm vs delta", "delta delta", "british airways", "nothing here", "@klm great"]
    model = _model(spark)
    t0 = dt.datetime(2024, 1, 1)
    per = score_mentions(_msgs(spark, texts), None, "klm, delta, British_Airways", model=model, run_id="r", processing_time=t0)
    rows = per.predictions.collect()
    # 'klm vs delta' twice (RT stripped) -> one text with retweets 1; per mention: klm, delta, delta, delta, klm
    assert sorted(r["airline"] for r in rows) == ["delta", "delta", "delta", "klm", "klm"]
    assert {r["comment"]: r["retweets"] for r in rows}["klm vs delta"] == 1
    assert len({r["id"] for r in rows}) == len(rows)
    tot = {r["airline"]: r["total_comments"] for r in per.scores.collect()}
    assert tot == {"delta": 3, "klm": 2}
    compat = score_mentions(_msgs(spark, texts), None, "klm, delta, British_Airways", model=model, compat=True,
                            run_id="r", processing_time=t0)
    crow = compat.predictions.collect()
    # last_mention: 'klm vs delta' -> delta x2 sharing one id -> one row; 'delta delta' -> one row
    assert sorted(r["airline"] for r in crow) == ["delta", "delta", "klm"]
    ctot = {r["airline"]: r["total_comments"] for r in compat.scores.collect()}
    assert ctot == {"delta": 4, "klm": 1}


def test_large_term_table_path_equals_inline(spark):
    texts = ["klm vs delta", "delta delta", "emirates and klm", "none"]
    model = _model(spark)
    terms_df = spark.createDataFrame([("klm",), ("delta",), ("Emirates",)], "term string")
    for mode in ["per_mention", "last_mention", "distinct"]:
        a = score_mentions(_msgs(spark, texts), None, terms_df, mode=mode, model=model, run_id="r",
                           processing_time=dt.datetime(2024, 1, 1))
        b = score_mentions(_msgs(spark, texts), None, terms_df, mode=mode, model=model, run_id="r",
                           processing_time=dt.datetime(2024, 1, 1), max_inline_terms=0)
        key = lambda rows: sorted((r["airline"], r["id"], r["comment"], r["prediction"]) for r in rows)
        assert key(a.predictions.collect()) == key(b.predictions.collect()), mode
        assert sorted(tuple(r) for r in a.scores.collect()) == sorted(tuple(r) for r in b.scores.collect())


def test_run_score_job_versions(spark):
    model = _model(spark)
    root = scratch_path(spark, "scores")
    preds = scratch_path(spark, "preds")
    s1 = run_score_job(spark, _msgs(spark, ["klm ok", "delta ok"]), None, "klm, delta", preds, root, model=model)
    s2 = run_score_job(spark, _msgs(spark, ["klm again", "klm more"]), None, "klm, delta", preds, root, model=model)
    got = {r["airline"]: r["total_comments"] for r in s2.collect()}
    assert got == {"klm": 2, "delta": 1}          # delta kept from the first run
    assert spark.read.parquet(preds).count() == 4  # one folder for each run
    assert s1.count() == 2


def test_sink_schemas_and_report_lines(spark):
    from pyspark.sql.types import _parse_datatype_string

    from brandpulse.operators.labels import random_split
    from brandpulse.sinks.writers import PREDICTIONS_SCHEMA, SCORES_SCHEMA, error_report

    res = score_mentions(_msgs(spark, ["klm vs delta", "delta"]), None, "klm, delta", model=_model(spark), run_id="r")
    assert res.predictions.schema.simpleString() == _parse_datatype_string(PREDICTIONS_SCHEMA).simpleString()
    assert res.scores.schema.simpleString() == _parse_datatype_string(SCORES_SCHEMA).simpleString()
    report = spark.createDataFrame([("train", 0.25), ("valid", 0.5)], "split string, error double")
    assert sorted(error_report(report)) == ["Training error:0.25", "Validation error:0.5"]
    df = spark.range(1000)
    a, b = random_split(df, seed=5)
    a2, _ = random_split(df, seed=5)
    assert a.count() + b.count() == 1000 and sorted(r[0] for r in a.collect()) == sorted(r[0] for r in a2.collect())


def test_windowed_dedup_stream_equals_batch(spark):
    """X4 with a watermark: per-day repeat counts, files arrive in time order (nothing late)."""
    from brandpulse.streaming.ingest import record_time

    src = scratch_path(spark, "timed_src")
    texts = ["klm hi", "RT klm hi", "delta x", "delta x", "other"]
    for day in range(3):
        lines = [json.dumps({"text": texts[(day + k) % len(texts)],
                             "created_at": f"Wed Oct {10 + day:02d} {k:02d}:19:24 +0000 2018"}) for k in range(7)]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)
    out, ckpt = scratch_path(spark, "o"), scratch_path(spark, "c")
    dedup_stream(spark, src, out, ckpt, max_files_per_trigger=1, window="1 day", watermark="1 hour").awaitTermination()
    got = sorted(tuple(r) for r in read_dedup_counts(spark, out, windowed=True).collect())
    raw = spark.read.text(src)
    rows = raw.select(record_text("value").alias("text"), record_time("value").alias("t"))
    want = sorted(tuple(r) for r in rows.groupBy(F.window("t", "1 day").alias("w"), "text").count().select(
        F.col("w.start"), F.col("w.end"), "text", F.col("count"), F.col("count") - 1).collect())
    assert got == want and len(want) > 5


def test_literal_rows_and_sink_layout_options(spark):
    """S4 literal relation; H3 one file per output part; H4 a fixed number of files."""
    import os

    from brandpulse.operators.labels import label_split
    from brandpulse.sinks.writers import write_label_split, write_predictions
    from brandpulse.sources.readers import literal_samples

    lit = literal_samples(spark, [(["a", "b"],), (["c"],)], "comment array<string>")
    assert lit.count() == 2 and lit.columns == ["comment"]

    def files(path):
        return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path.replace("file:", ""))
                      for f in fs if f.startswith("part-"))

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", F.col("text").alias("content"),
                                                                    (F.col("doc_id") % 2).cast("string").alias("recommended"))
    one = scratch_path(spark, "k1")
    write_label_split(label_split(docs, "doc_id"), one, single_file=True, fmt="parquet")
    parts = files(one)
    assert len(parts) == len({os.path.dirname(p) for p in parts}) == 4
    preds = spark.range(1000).select(F.lit("klm").alias("airline"), F.col("id").cast("string").alias("id"))
    out = scratch_path(spark, "k3")
    write_predictions(preds, out, "r1", num_files=3, partition_by_term=False)
    assert len(files(out)) == 3


def test_a_run_written_twice_repeats_no_row(spark):
    from brandpulse.sinks.writers import read_predictions

    model, root, preds = _model(spark), scratch_path(spark, "scores"), scratch_path(spark, "preds")
    for compat in (False, True):
        for _ in range(2):
            scores = run_score_job(spark, _msgs(spark, ["klm and delta", "klm klm", "delta ok"]), None, "klm, delta", preds,
                                   root, model=model, run_id=f"run-{compat}", compat=compat)
        rows = read_predictions(spark, preds, f"run-{compat}").collect()
        assert len(rows) == len({(r["airline"], r["id"]) for r in rows})
        got = {r["airline"]: r["total_comments"] for r in scores.collect()}
        assert got == ({"delta": 3, "klm": 2} if compat else {"klm": 3, "delta": 2})
    assert {r["processing_id"] for r in read_predictions(spark, preds).collect()} == {"run-False", "run-True"}


def test_unfinished_score_version_is_skipped(spark):
    import os

    from brandpulse.sinks.writers import latest_scores, write_scores_version

    root = scratch_path(spark, "versions")
    one = spark.createDataFrame([("klm", 0.5, "r1", 2, 1)], "airline string, score double, processing_id string, "
                                "total_comments bigint, positive_comments bigint")
    write_scores_version(spark, one, root)
    os.makedirs(f"{root.replace('file:', '')}/version=1")       # a writer that was lost before it committed
    assert [r["airline"] for r in latest_scores(spark, root).collect()] == ["klm"]
    target = write_scores_version(spark, one.withColumn("airline", F.lit("delta")), root)
    assert target.endswith("version=2")
    assert sorted(r["airline"] for r in latest_scores(spark, root).collect()) == ["delta", "klm"]


def test_one_term_rule_for_all_forms(spark):
    model = _model(spark)
    table = spark.createDataFrame([("Virgin America",), (None,), ("klm",), ("KLM ",)], "term string")
    texts = ["virginamerica and klm", "klm", "virgin america", None]
    messages = _msgs(spark, texts)
    got = set()
    for terms, limit in (("Virgin America,klm,KLM ", 10), (["Virgin America", None, "klm", "KLM "], 10),
                         (["Virgin America", None, "klm"], 1), (table, 10), (table, 1)):
        res = score_mentions(messages, None, terms, model=model, run_id="r", max_inline_terms=limit)
        got.add(tuple(sorted((r["airline"], r["total_comments"]) for r in res.scores.collect())))
    assert got == {(("klm", 2), ("virginamerica", 1))}


def test_scratch_folder_must_be_named_on_a_cluster():
    import pytest

    from brandpulse.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_files_are_dealt_by_text_and_brand_and_shuffles_freed(spark, tmp_path):
    import os
    import time

    from brandpulse.session import shuffles_freed

    model, texts = _model(spark), ["klm vs delta klm klm", "delta", "klm delta delta", "none"] * 2
    for mode in ("per_mention", "last_mention", "distinct"):
        res = score_mentions(_msgs(spark, texts), None, "klm, delta", mode=mode, model=model, run_id="r")
        rows = res.rows_of(res.by_brand)
        assert rows.columns == res.predictions.columns
        drop = "processing_time"
        assert sorted(map(str, rows.drop(drop).collect())) == sorted(map(str, res.predictions.drop(drop).collect()))
        assert res.by_brand.count() == (3 if mode == "last_mention" else 5)

    def shuffled():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}

    rows, before = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), shuffled()
    with shuffles_freed(spark):
        rows.write.parquet(f"{tmp_path}/rows")
    for _ in range(100):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
