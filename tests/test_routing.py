"""Dead letters and their replay, term tables that change, records collected under several terms, ranks over ranges."""

import json

import pytest
from pyspark.sql import functions as F

from brandpulse.functions.text import parsed_record, record_text
from brandpulse.operators.dedup_records import dedup_record_stream, dedup_records
from brandpulse.operators.scoring import count_repeats, rank_entities
from brandpulse.plans.composites import message_texts
from brandpulse.session import scratch_path
from brandpulse.streaming.ingest import routed_records
from brandpulse.streaming.routing import (
    deadletter_stream,
    put_terms,
    read_dead,
    read_records,
    replay_dead,
    route_table_stream,
    routed_by_table,
    tracked_terms,
)

LINES = ['{"text": "RT klm é ok"}', '{"text": "x"} ', "", "  ", '{"text": 5}', '{"text": null}', '{"a": 1}', '{"text": "cut',
         "[1]", "{}{}", '"x"', '{"text": {"a": 1}}', '{"text": ""}', "]{[", '{"text": "a"}{"text": "b"}']


def test_one_parse_says_what_record_text_says(spark):
    df = spark.createDataFrame([(x,) for x in LINES] + [(None,)], "value string")
    rows = df.select("value", parsed_record("value").alias("p"), record_text("value").alias("t")).collect()
    for r in rows:
        assert (r["p"]["text"] is None) != (r["p"]["reason"] is None) and r["p"]["text"] == r["t"], r
    reasons = {r["value"]: r["p"]["reason"] for r in rows}
    assert reasons[None] == reasons[""] == reasons["  "] == "empty" and reasons['{"text": 5}'] == "text_not_string"
    assert reasons['{"text": null}'] == reasons['{"a": 1}'] == "no_text" and reasons["{}{}"] == reasons["[1]"] == "malformed"


def test_dead_letters_and_replay(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    spark.createDataFrame([(x,) for x in LINES], "value string").repartition(4).write.text(src)
    deadletter_stream(spark, src, out, ckpt, max_files_per_trigger=2).awaitTermination()
    records, dead = read_records(spark, out), read_dead(spark, out)
    assert sorted(r["value"] for r in records.unionByName(dead.select("value", F.lit(None).cast("string").alias("text"))).collect()) == sorted(LINES)
    assert sorted(r["text"] for r in records.collect()) == ["", "klm  ok", "x"]
    before = dead.count()
    assert replay_dead(spark, out, lambda v: F.when(v == '{"text": "cut', F.concat(v, F.lit('"}'))).otherwise(v)) == 0
    assert sorted(r["text"] for r in read_records(spark, out).collect()) == ["", "cut", "klm  ok", "x"]
    assert read_dead(spark, out).count() == before - 1
    replay_dead(spark, out, lambda v: F.when(v == '{"text": 5}', F.lit('{"text": "5"}')).otherwise(v))
    assert read_records(spark, out).count() == 5 and read_dead(spark, out).count() == before - 2


def test_terms_added_and_dropped_between_batches(spark):
    src, out, ckpt, root = (scratch_path(spark, n) for n in ("src", "out", "ckpt", "terms"))
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "term string")
    post = lambda *t: spark.createDataFrame([(json.dumps({"text": x}),) for x in t], "value string").coalesce(1).write.mode("append").text(src)
    run = lambda: route_table_stream(spark, src, out, ckpt, root).awaitTermination()
    put_terms(spark, root, words("KLM", None))
    post("klm and delta", "delta only", "klm klm")
    run()
    put_terms(spark, root, words("delta"))
    post("delta too", "klm and delta again")
    run()
    put_terms(spark, root, words("KLM"), active=False)
    post("klm is gone, delta stays")
    run()
    got = sorted((json.loads(r["value"])["text"], r["stream"]) for r in spark.read.text(out).collect())
    assert got == [("delta too", "stream_delta.json"), ("klm and delta", "stream_klm.json"), ("klm and delta again", "stream_delta.json"),
                   ("klm and delta again", "stream_klm.json"), ("klm is gone, delta stays", "stream_delta.json"), ("klm klm", "stream_klm.json")]


def test_many_terms_route_like_a_list(spark):
    texts = [f"w{i} and w{i * 7 % 50} w{i}" for i in range(60)]
    raw = spark.createDataFrame([(json.dumps({"text": t}),) for t in texts] * 2, "value string").repartition(4)
    terms = [f"w{i}" for i in range(0, 100_000, 3)]
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    key = lambda df: sorted(map(tuple, df.select("value", "term", "stream").collect()))
    assert key(routed_by_table(raw, table)) == key(routed_records(raw, [t for t in terms if int(t[1:]) < 100]))


def test_records_meet_a_small_table_without_a_shuffle(spark):
    texts = ["klm and KLM and delta", "klm and KLM and delta", "nothing", "iberia", ""]
    raw = spark.createDataFrame([(json.dumps({"text": t}),) for t in texts] + [("broken",), (None,)], "value string").repartition(3)
    table = spark.createDataFrame([("K LM",), ("klm",), ("delta",), ("iberia",), (None,)], "term string")
    out = routed_by_table(raw, table)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "collect_list" not in plan and "BroadcastHashJoin" in plan
    both = json.dumps({"text": texts[0]})
    assert sorted((r["value"], r["term"]) for r in out.collect()) == sorted(
        [(both, "klm"), (both, "delta")] * 2 + [(json.dumps({"text": "iberia"}), "iberia")])
    assert routed_by_table(raw, table.where("false")).count() == 0


def test_records_collected_under_several_terms(spark):
    terms = ["klm", "delta", "iberia"]
    rows = [{"id": i, "text": t} for i, t in enumerate(["klm and delta", "klm and delta", "delta", "klm iberia delta", "nothing"])]
    rows += [{"id": "7", "text": "klm"}, {"text": "klm without id"}, {"text": "klm without id"}]
    raw = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").repartition(3)
    out = scratch_path(spark, "routed")
    routed_records(raw, terms).select("value", "stream").write.partitionBy("stream").text(out)
    back = spark.read.text(out).select("value")
    assert back.count() == 2 + 2 + 1 + 3 + 1 + 2
    counts = lambda df: sorted(map(tuple, count_repeats(message_texts(df), "text").collect()))
    named = raw.where(F.col("value").rlike("klm|delta|iberia"))
    assert counts(dedup_records(back)) == counts(named)


def test_record_stream_keeps_one_of_an_id(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    lines = [json.dumps({"id": i % 5, "text": f"t{i % 5}"}) for i in range(20)] + [json.dumps({"text": "no id"})] * 3
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(4).write.text(src)
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src).withColumn("at", F.current_timestamp())
    dedup_record_stream(raw, "at").select("value").writeStream.format("text").option("checkpointLocation", ckpt) \
        .trigger(availableNow=True).start(out).awaitTermination()
    got = sorted(r["value"] for r in spark.read.text(out).collect())
    assert got == sorted([json.dumps({"id": i, "text": f"t{i}"}) for i in range(5)] + [json.dumps({"text": "no id"})] * 3)


@pytest.mark.parametrize("ranges", ["1", "7"])
def test_rank_over_ranges(spark, ranges):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        rows = [(f"e{i}", (i * 13 % 23) / 23 if i % 11 else None, i % 4) for i in range(300)]
        df = spark.createDataFrame(rows, "term string, score double, total_comments long")
        ranked = rank_entities(df, min_comments=1)
        plan = ranked._jdf.queryExecution().optimizedPlan().toString()
        assert "Window [" in plan and all("[_range" in line for line in plan.split("\n") if "Window [" in line)
        kept = [r for r in rows if r[2] >= 1]
        order = lambda s: float("-inf") if s is None else s
        want = sorted((t, 1 + sum(order(o) > order(s) for _, o, _ in kept)) for t, s, _ in kept)
        assert sorted((r["term"], r["rank"]) for r in ranked.collect()) == want
        top = sorted((r["term"], r["rank"]) for r in rank_entities(df, min_comments=1, top_k=20).collect())
        assert top == [w for w in want if w[1] <= 20]
        assert rank_entities(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
