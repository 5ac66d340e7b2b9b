"""Operators: labelled lines (3.6), mentions (3.4), dedup (3.3), score (3.5), rank, upsert."""

import pytest
from pyspark.sql import functions as F

from brandpulse.functions.text import clean_tokens, ascii_strip
from brandpulse.operators import labels as L
from brandpulse.operators.mentions import explode_mentions, explode_mentions_join
from brandpulse.operators.scoring import count_repeats, error_rate, rank_entities, score_entities
from brandpulse.operators.upsert import latest_per_key, upsert_latest
from conftest import SF01


def test_parse_labeled_golden(spark):
    lines = ["fine:::1", "fine::: 1 ", "fine:::1.0", "fine:::None", "fine", "a:::b:::1", "ends::::1", ":::1"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted((r["comment"], r["sentiment"]) for r in L.parse_labeled(df).collect())
    assert got == [("", 1), ("fine", 1), ("fine", 1)]


def test_serialize_labeled(spark):
    df = spark.createDataFrame([("good", "1"), (None, "0"), ("x", None)], "c string, r string")
    got = [r[0] for r in df.select(L.serialize_labeled("c", "r")).collect()]
    assert got == ["good:::1", "None:::0", "x:::None"]


def test_reviews_to_training_compat_loses_colons(spark):
    df = spark.createDataFrame([("a:::b", "1"), ("ends:", "1"), ("ok", "0"), ("bad", "x")], "content string, recommended string")
    assert sorted(r["comment"] for r in L.reviews_to_training(df).collect()) == ["a b", "ends", "ok"]
    assert [r["comment"] for r in L.reviews_to_training(df, compat=True).collect()] == ["ok"]


def test_hash_split_is_stable(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    a = {r[0]: r[1] for r in docs.select("doc_id", L.split_column("doc_id")).collect()}
    b = {r[0]: r[1] for r in docs.repartition(7).select("doc_id", L.split_column("doc_id")).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.75 < share < 0.85


MENTION_CASES = [
    (["klm", "vs", "delta"], {"per_mention": ["klm", "delta"], "last_mention": ["delta", "delta"], "distinct": ["klm", "delta"]}),
    (["delta", "delta"], {"per_mention": ["delta", "delta"], "last_mention": ["delta", "delta"], "distinct": ["delta"]}),
    (["british", "airways"], {"per_mention": [], "last_mention": [], "distinct": []}),
    (["americanairlines"], {"per_mention": [], "last_mention": [], "distinct": []}),
]
TERMS = ["klm", "delta", "british_airways"]


@pytest.mark.parametrize("mode", ["per_mention", "last_mention", "distinct"])
def test_mention_modes(spark, mode):
    df = spark.createDataFrame([(i, toks) for i, (toks, _) in enumerate(MENTION_CASES)], "id int, tokens array<string>")
    out = explode_mentions(df, "tokens", TERMS, mode)
    got = {i: [] for i in range(len(MENTION_CASES))}
    for r in out.orderBy("id").collect():
        got[r["id"]].append(r["term"])
    for i, (_, want) in enumerate(MENTION_CASES):
        assert sorted(got[i]) == sorted(want[mode]), (mode, i)
    joined = explode_mentions_join(df, "tokens", spark.createDataFrame([(t,) for t in TERMS], "term string"), mode)
    got_j = sorted((r["id"], r["term"]) for r in joined.collect())
    assert got_j == sorted((r["id"], r["term"]) for r in out.collect())


@pytest.mark.parametrize("mode", ["per_mention", "last_mention", "distinct"])
def test_join_path_equals_inline_on_documents(spark, mode):
    terms = ["that", "with", "this", "from", "tion", "than"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", clean_tokens(ascii_strip("text")).alias("tokens"))
    inline = sorted(tuple(r) for r in explode_mentions(docs, "tokens", terms, mode).collect())
    tdf = spark.createDataFrame([(t,) for t in terms], "term string")
    joined = sorted(tuple(r) for r in explode_mentions_join(docs, "tokens", tdf, mode).select("doc_id", "term").collect())
    assert inline == joined and len(inline) > 1000


def test_dedup_golden(spark):
    from brandpulse.functions.text import record_text

    lines = ['{"text":"RT @klm hi"}', '{"text":"@klm hi"}', '{"text":"@delta x"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string").select(record_text("value").alias("text"))
    got = sorted(tuple(r) for r in count_repeats(df, "text").collect())
    assert got == [("@delta x", 1, 0), ("@klm hi", 2, 1)]


def test_score_golden(spark):
    df = spark.createDataFrame([("klm", 1), ("klm", 0), ("klm", 1), ("delta", 0)], "airline string, prediction int")
    got = {r["airline"]: (r["score"], r["total_comments"], r["positive_comments"])
           for r in score_entities(df, "airline").collect()}
    assert got == {"klm": (2 / 3, 3, 2), "delta": (0.0, 1, 0)}
    ranked = {r["airline"]: r["rank"] for r in rank_entities(score_entities(df, "airline"), "airline").collect()}
    assert ranked == {"klm": 1, "delta": 2}
    assert rank_entities(score_entities(df, "airline"), "airline", min_comments=2).count() == 1


def test_error_rate(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1)], "label int, prediction int")
    r = error_rate(df).first()
    assert (r["n"], r["wrong"], r["error"]) == (4, 2, 0.5)


def test_upsert_latest_keeps_absent_keys(spark):
    old = spark.createDataFrame([("klm", 0.5, "r1"), ("delta", 0.1, "r1")], "airline string, score double, run string")
    new = spark.createDataFrame([("klm", 0.9, "r2"), ("emirates", 1.0, "r2")], "airline string, score double, run string")
    got = sorted(tuple(r) for r in upsert_latest(old, new, ["airline"]).collect())
    assert got == [("delta", 0.1, "r1"), ("emirates", 1.0, "r2"), ("klm", 0.9, "r2")]


def test_latest_per_key_with_hot_key(spark):
    """A key holding a third of the rows: same answer as a window, via partial max_by."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"))
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["v"]).collect()}
    assert got[-1] == max(i for i in range(n) if i % 3 == 0)
    assert len(got) == 1 + len({i % 1000 for i in range(n) if i % 3})
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial" in plan


def test_match_terms_table_equals_inline_on_documents(spark):
    from brandpulse.operators.mentions import match_terms, match_terms_table

    terms = ["that", "with", "this", "from", "tion", "than"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", clean_tokens(ascii_strip("text")).alias("tokens"))
    inline = {r["doc_id"]: r["h"] for r in docs.select("doc_id", match_terms("tokens", terms).alias("h")).collect() if r["h"]}
    tdf = spark.createDataFrame([(t.upper(),) for t in terms], "term string")
    table = {r["doc_id"]: r["hits"] for r in match_terms_table(docs, "tokens", tdf).collect()}
    assert table == inline and len(table) > 100


def _py_mentions(tokens, terms, mode):
    hits = [t.lower() for t in tokens if t.lower() in terms]
    if mode == "per_mention":
        return hits
    if mode == "last_mention":
        return [hits[-1]] * len(hits) if hits else []
    return list(dict.fromkeys(hits))


@pytest.mark.parametrize("mode", ["per_mention", "last_mention", "distinct"])
def test_mention_modes_match_python_on_random_tokens(spark, mode):
    import random

    rnd = random.Random(11)
    vocab = ["klm", "KLM", "delta", "Delta", "x", "", "british_airways", "vs", "jetblue"]
    terms = ["klm", "delta", "jetblue", "british_airways"]
    rows = [(i, [rnd.choice(vocab) for _ in range(rnd.randint(0, 8))]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    got = {}
    for r in explode_mentions(df, "tokens", terms, mode, with_position=True).collect():
        got.setdefault(r["id"], []).append((r["mention_pos"], r["term"]))
    for i, toks in rows:
        assert [t for _, t in sorted(got.get(i, []))] == _py_mentions(toks, set(terms), mode), (i, toks)


def test_scores_match_python_on_random_mentions(spark):
    """Repeat counts and per-entity scores against a Python computation (many repeats, one hot key)."""
    import random
    from collections import Counter

    from brandpulse.plans.composites import score_mentions

    class FixedModel:  # prediction = 1 when the text holds 'good'
        input_col = "comment"

        def predict(self, df):
            return df.withColumn("prediction", F.array_contains("comment", "good").cast("int"))

    rnd = random.Random(5)
    texts = ["klm good", "klm bad", "delta good delta", "jetblue klm good", "nothing"]
    weights = [40, 5, 10, 3, 2]          # 'klm good' holds most of the rows
    msgs = [rnd.choices(texts, weights)[0] for _ in range(600)]
    import json as _json

    df = spark.createDataFrame([(_json.dumps({"text": t}),) for t in msgs], "value string")
    res = score_mentions(df, None, "klm, delta, jetblue", model=FixedModel(), run_id="r")
    got = {r["airline"]: (r["total_comments"], r["positive_comments"], r["score"]) for r in res.scores.collect()}
    want_tot, want_pos = Counter(), Counter()
    for t in set(msgs):                   # each distinct text counts once per mention
        toks = t.split(" ")
        for term in [x for x in toks if x in {"klm", "delta", "jetblue"}]:
            want_tot[term] += 1
            want_pos[term] += int("good" in toks)
    assert got == {k: (want_tot[k], want_pos[k], want_pos[k] / want_tot[k]) for k in want_tot}
    reps = {r["comment"]: r["retweets"] for r in res.predictions.collect()}
    assert all(reps[t] == msgs.count(t) - 1 for t in reps)
