"""Model: invariants on small fixtures and the driver tables."""

import pytest

from brandpulse.operators.model import SentimentModel, doc_vectors, fit_sentiment, sample_eval, word2vec
from brandpulse.operators.scoring import error_rate
from conftest import SF001

GOOD = "great friendly crew smooth flight on time comfortable seats".split()
BAD = "rude staff late lost bags dirty seats cancelled delayed".split()


def _separable(spark, n=200):
    rows = []
    for i in range(n):
        words = GOOD if i % 2 else BAD
        toks = [words[(i + k) % len(words)] for k in range(6)]
        rows.append((toks, i % 2))
    return spark.createDataFrame(rows, "comment array<string>, sentiment int")


def test_vocabulary_is_distinct_tokens(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["c", ""],)], "comment array<string>")
    model = word2vec(vector_size=4, min_count=0, seed=1).fit(df)
    assert sorted(r[0] for r in model.getVectors().select("word").collect()) == ["", "a", "b", "c"]


def test_doc_vector_rule_and_join_path(spark):
    train = spark.createDataFrame([(["a", "b"],), (["b", "c"],)], "comment array<string>")
    w2v = word2vec(vector_size=3, min_count=0, seed=1).fit(train)
    docs = spark.createDataFrame([(1, ["a"]), (2, ["a", "zzz"]), (3, ["zzz"]), (4, [])], "k int, comment array<string>")
    lib = {r["k"]: r["result"].toArray().tolist() for r in w2v.transform(docs).collect()}
    assert lib[2] == pytest.approx([x / 2 for x in lib[1]])
    assert lib[3] == [0.0, 0.0, 0.0] and lib[4] == [0.0, 0.0, 0.0]
    joined = {r["k"]: r["result"] for r in doc_vectors(docs, "comment", w2v.getVectors(), ["k"], 3).collect()}
    for k in lib:
        assert joined[k] == pytest.approx(lib[k], abs=1e-6)
    # Forced join path inside the model gives the same predictions as the broadcast path.
    model = fit_sentiment(spark.createDataFrame([(["a", "b"], 1), (["b", "c"], 0)], "comment array<string>, sentiment int"),
                          vector_size=3, iterations=5, seed=1)
    a = {r["k"]: r["prediction"] for r in model.predict(docs).collect()}
    b = {r["k"]: r["prediction"] for r in model.predict(docs, max_broadcast_bytes=0).collect()}
    assert a == b


def test_separable_set_is_learned_and_repeatable(spark):
    df = _separable(spark)
    m1 = fit_sentiment(df, vector_size=16, iterations=50, seed=3)
    err = error_rate(m1.predict(df), "sentiment").first()["error"]
    assert 0.0 <= err < 0.5 - 0.1   # better than the majority class (0.5)
    m2 = fit_sentiment(df, vector_size=16, iterations=50, seed=3)
    p1 = [r[0] for r in m1.predict(df).select("prediction").collect()]
    p2 = [r[0] for r in m2.predict(df).select("prediction").collect()]
    assert p1 == p2


def test_sgd_trainer_and_save_load(spark):
    from brandpulse.session import scratch_path

    df = _separable(spark, 100)
    m = fit_sentiment(df, vector_size=8, iterations=20, seed=3, trainer="sgd")
    path = scratch_path(spark, "model")
    m.save(path)
    loaded = SentimentModel.load(spark, path)
    a = [r[0] for r in m.predict(df).select("prediction").collect()]
    b = [r[0] for r in loaded.predict(df).select("prediction").collect()]
    assert a == b and loaded.weights == m.weights


def test_sample_eval_uses_uncleaned_split(spark):
    df = _separable(spark, 60)
    m = fit_sentiment(df, vector_size=8, iterations=10, seed=3)
    samples = spark.read.parquet(f"{SF001}/benchmark.parquet").select("text")
    r = sample_eval(m, samples, "text", label=1).first()
    assert r["n"] == samples.count() and 0.0 <= r["error"] <= 1.0


def test_training_rows_are_bounded_not_refused(spark):
    from brandpulse.operators.model import training_sample

    df = _separable(spark, 400)
    some = training_sample(df.select("comment", "sentiment"), 100, ["comment", "sentiment"])
    assert sorted(map(str, some.collect())) == sorted(map(str, training_sample(
        df.repartition(7).select("comment", "sentiment"), 100, ["comment", "sentiment"]).collect()))
    assert training_sample(df, 400, ["comment", "sentiment"]).count() == 400
    assert fit_sentiment(df, vector_size=4, iterations=2, seed=1, max_train_rows=200).predict(df).count() == 400


def test_equal_token_lists_get_their_own_margin(spark):
    """The folded path equals transform + classifier, with an intercept, on texts that clean to equal tokens."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from brandpulse.operators.model import linear_margin, token_margins, word_scores

    w2v = word2vec(vector_size=3, min_count=0, seed=1, num_partitions=1).fit(
        spark.createDataFrame([(["klm", "great"],), (["bad", "klm"],)], "comment array<string>"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        [["klm", "great"]] * 3 + [["bad"], ["bad", "unknown"], ["unknown"], [], ["klm", "klm"]])], "k int, comment array<string>")
    weights, intercept = [0.5, -1.0, 2.0], -0.01
    want = {r[0]: r[1] for r in w2v.transform(docs).select(
        "k", linear_margin(vector_to_array("result"), weights, intercept)).collect()}
    for limit in (0, 1 << 20):
        got = token_margins(docs, "comment", word_scores(w2v.getVectors(), weights), intercept, max_broadcast_bytes=limit)
        for r in got.collect():
            assert r["margin"] == pytest.approx(want[r["k"]], abs=1e-6)


def test_single_estimator_save_load(spark):
    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F

    from brandpulse.operators.model import sentiment_estimator
    from brandpulse.session import scratch_path

    df = _separable(spark, 80).withColumn("label", F.col("sentiment").cast("double"))
    fitted = sentiment_estimator(vector_size=8, iterations=10, seed=2).fit(df)
    path = scratch_path(spark, "estimator")
    fitted.write().save(path)
    again = PipelineModel.load(path)
    a = [r[0] for r in fitted.transform(df).select("prediction").collect()]
    b = [r[0] for r in again.transform(df).select("prediction").collect()]
    assert a == b


def test_vectors_are_learned_without_a_vocabulary_on_the_driver(spark):
    """Spark ML's model is a driver object; the table's vectors depend on the rows and the seed only."""
    from pyspark.sql import functions as F

    from brandpulse.operators.word_parts import fit_word_parts
    from brandpulse.operators.word_table import WordTable
    from test_word_table import planted, rows_of

    df = spark.createDataFrame(planted(800) + [(["copy", "of", "one"],)] * 50 + [(None,), ([],), (["x", None, ""],)], "comment array<string>")
    kw = dict(dim=16, passes=4, seed=3)
    table = fit_word_parts(df, words_per_part=2500, **kw)
    assert isinstance(table, WordTable) and isinstance(word2vec(vector_size=4, seed=1).fit(df.limit(5)), WordTable)
    vec = rows_of(table)
    assert set(vec) == {r[0] for r in df.select(F.explode("comment").alias("w")).where("w IS NOT NULL").distinct().collect()}
    assert vec == rows_of(fit_word_parts(df.repartition(7), words_per_part=2500, **kw))
    assert vec != rows_of(fit_word_parts(df, words_per_part=2500, **{**kw, "seed": 4}))
    whole = fit_word_parts(df, **kw)
    for t in range(6):
        assert whole.nearest(f"left{t}", 1).first()["word"] == f"right{t}"
        # Means of three small parts: the topic's own words are nearer than the filler.
        assert table.nearest(f"left{t}", 1).first()["word"].split("_")[0] in (f"right{t}", f"pre{t}", f"post{t}")
    assert set(rows_of(fit_word_parts(df, min_count=50, **kw))) == {
        r[0] for r in df.select(F.explode("comment").alias("w")).groupBy("w").count().where("count >= 50 AND w IS NOT NULL").collect()}


def test_sums_by_parts_are_the_broadcast_ones(spark):
    from pyspark.sql import functions as F

    from brandpulse.operators.token_parts import list_key, list_sums

    lists = [["a", "b", "a"], ["zzz"], [], None, ["b", None, "c"], ["a", "b", "a"], ["c"] * 40_000]
    df = spark.createDataFrame(list(enumerate(lists)), "k int, t array<string>").withColumns(list_key("t"))
    words = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [10.0, 0.0]), ("c", [0.0, -1.0]), ("other", [5.0, 5.0])], "_w string, _v array<double>")
    for per_part in (3, 1 << 20):
        got = {r["k"]: (r["_n"], r["_sum"]) for r in df.join(list_sums(df, "t", words, 2, per_part), ["_k1", "_k2"]).collect()}
        assert got == {0: (3, [12.0, 4.0]), 1: (1, [0.0, 0.0]), 2: (0, [0.0, 0.0]), 3: (0, [0.0, 0.0]), 4: (3, [10.0, -1.0]),
                       5: (3, [12.0, 4.0]), 6: (40_000, [0.0, -40_000.0])}
    pairs = spark.createDataFrame([(1, ["a"]), (1, ["b", "x"]), (2, None), (2, ["c"])], "k int, t array<string>")
    want = doc_vectors(pairs, "t", words, ["k"], 2, word_col="_w", vector_col="_v").orderBy("k").collect()
    assert doc_vectors(pairs, "t", words, ["k"], 2, word_col="_w", vector_col="_v", max_broadcast_bytes=0).orderBy("k").collect() == want
    assert [r["result"] for r in want] == [[11 / 3, 2 / 3], [0.0, -0.5]]


def test_repeated_and_null_words_count_alike_on_both_paths(spark):
    from brandpulse.operators.model import token_margins

    words = spark.createDataFrame([("a", 3.0), ("a", 6.0), ("b", 1.0), (None, 9.0), ("c", None)], "_w string, _s double")
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", None, "x"]), (3, []), (4, None), (5, ["a"])], "k int, t array<string>")
    small, parts = ({r["k"]: r["margin"] for r in token_margins(docs, "t", words, -1.0, max_broadcast_bytes=b).collect()} for b in (1 << 20, 0))
    assert small == parts and small[1] == -1.0 + 10 / 3 and small[5] == 3.5


def test_lists_are_dealt_whole_and_only_their_sums_are_grouped(spark):
    # No aggregate or sort before the parts holds a token list, and the copies of one list are dealt to many parts.
    from brandpulse.operators.token_parts import list_key, list_sums

    df = spark.createDataFrame([(["a", f"w{k % 3}"],) for k in range(300)] + [(["a"] * 5,)] * 200, "t array<string>").withColumns(list_key("t"))
    words = spark.createDataFrame([("a", [1.0]), ("w1", [4.0])], "_w string, _v array<float>")
    sums = list_sums(df, "t", words, 1, tokens_per_part=20)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "first(_t" not in plan and "first(_sum" in plan and "REPARTITION_BY_NUM" in plan
    assert sorted((r["_n"], r["_sum"][0]) for r in sums.collect()) == [(2, 1.0), (2, 1.0), (2, 5.0), (5, 5.0)]


def test_a_table_the_driver_would_feel_is_not_broadcast(spark):
    from brandpulse.operators.model import token_margins

    words = spark.range(100_000).selectExpr("concat('w', id) AS _w", "CAST(id % 7 AS DOUBLE) AS _s")
    docs = spark.createDataFrame([(k, [f"w{k}", "none"]) for k in range(20)], "k int, t array<string>")
    out = token_margins(docs, "t", words, 0.5)
    assert "BroadcastHashJoin" not in out.select("margin")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in out._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: r["margin"] for r in out.collect()} == {k: 0.5 + (k % 7) / 2 for k in range(20)}


def test_a_report_reads_token_rows_written_once(spark):
    from brandpulse.operators.model import train_and_report

    rows = spark.createDataFrame([(["good", "flight"], 1, "train"), (["bad", "flight"], 0, "train"), (["good"], 1, "valid")] * 10,
                                 "comment array<string>, sentiment int, split string").selectExpr("*", "rand() AS _r").drop("_r")
    _, report = train_and_report(rows, vector_size=4, iterations=5, seed=3)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan
    assert {(r["split"], r["n"]) for r in report.collect()} == {("train", 20), ("valid", 10)}


@pytest.mark.parametrize("trainer", ["dual", "sgd", "linearsvc"])
def test_a_fit_uses_all_rows_unless_told_otherwise(spark, monkeypatch, trainer):
    from brandpulse.operators import model

    def refuse(*_):
        raise AssertionError("rows were left out")

    monkeypatch.setattr(model, "training_sample", refuse)
    fit_sentiment(_separable(spark, 40), vector_size=4, iterations=2, seed=1, trainer=trainer)
