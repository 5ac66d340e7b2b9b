"""Word vectors over partitioned tables: pairs against plain counting, planted neighbours, reruns, restarts, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brandpulse.operators.word_table import (
    WordTable, context_counts, fit_word_table, learn_block, word_counts, word_pairs)

SMALL = dict(dim=12, epochs=2, min_buckets=3, seed=5)


def planted(n=1500, topics=6, seed=1):
    """A topic's two names stand between the same marks, never together, among filler that all topics share."""
    rng = random.Random(seed)

    def filler():
        return f"f{rng.randrange(40)}"

    out = []
    for _ in range(n):
        t = rng.randrange(topics)
        marks = f"pre{t}_{rng.randrange(2)}", rng.choice([f"left{t}", f"right{t}"]), f"post{t}_{rng.randrange(2)}"
        out.append(([filler(), filler(), *marks, filler(), filler()],))
    return out


def rows_of(table):
    return {r["word"]: tuple(r["vector"]) for r in table.getVectors().collect()}


def test_pairs_are_counted_like_a_plain_loop(spark):
    rng = random.Random(3)
    docs = [[rng.choice("abcdefg") for _ in range(rng.randrange(0, 30))] for _ in range(40)] + [["a"] * 25, [""], []]
    df = spark.createDataFrame([(d,) for d in docs] + [(None,), (["x", None, "y"],)], "t array<string>")
    want, window, cut = Counter(), 3, 7
    for d in docs + [["x", "y"]]:
        for s in (d[k:k + cut] for k in range(0, len(d), cut)):
            for i in range(len(s)):
                for j in range(i + 1, min(i + window + 1, len(s))):
                    want[min(s[i], s[j]), max(s[i], s[j])] += window + 1 - (j - i)
    got = {(r["a"], r["b"]): r["n"] for r in word_pairs(df, "t", window, cut).collect()}
    assert got == dict(want)
    counts = Counter(w for d in docs + [["x", "y"]] for w in d)
    assert {r["word"]: r["n"] for r in word_counts(df, "t").collect()} == dict(counts)
    assert {r["word"] for r in word_counts(df, "t", 10).collect()} == {w for w, n in counts.items() if n >= 10}
    near = {r["word"]: (r["contexts"], r["weight"]) for r in context_counts(word_counts(df, "t"), word_pairs(df, "t", window, cut)).collect()}
    for w in counts:
        ends = [(p, n) for p, n in want.items() if w in p]
        assert near[w] == (len(ends), sum(n * (2 if p[0] == p[1] else 1) for p, n in ends))


def test_pairs_are_counted_before_the_shuffle(spark, monkeypatch):
    from brandpulse.operators import word_table

    docs = [["é", "z", "a", "é", "\U0001F600"]] * 50 + [["z", "a"]] * 30 + [["one"], []]
    rows = spark.createDataFrame([(d,) for d in docs], "t array<string>").coalesce(1)
    pairs = word_pairs(rows, "t", 2, 4)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.index("HashAggregate") < plan.index("Exchange hashpartitioning")
    near = [("z", "é", 2), ("a", "é", 1), ("a", "z", 2), ("z", "é", 1), ("a", "é", 2)]
    want = Counter()
    for a, b, n in near:
        want[a, b] += 50 * n
    want["a", "z"] += 30 * 2
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == dict(want)
    # A task's chunks: a batch is cut where a chunk is full, and a pair comes once from each.
    import pyarrow as pa

    monkeypatch.setattr(word_table, "CHUNK_WORDS", 40)
    batches = [pa.record_batch([pa.array([["x", "y", "y"]] * 30, pa.list_(pa.string()))], ["_s"])] * 2
    got = [(a, b, n) for out in word_table._met(2)(batches) for a, b, n in zip(*(c.to_pylist() for c in out.columns))]
    assert len(got) < 20 and sum(n for a, b, n in got if (a, b) == ("x", "y")) == 60 * 3 and sum(n for *_, n in got) == 60 * 5


def test_planted_words_are_nearest(spark):
    table = fit_word_table(spark.createDataFrame(planted(), "comment array<string>"), dim=16, epochs=8, min_buckets=4, seed=3)
    vec = rows_of(table)
    for t in range(6):
        best = table.nearest(f"left{t}", 3).collect()
        assert best[0]["word"] == f"right{t}" and best[0]["cosine"] >= best[1]["cosine"]
        x, y = np.array(vec[f"left{t}"]), np.array(vec[f"right{t}"])
        assert abs(best[0]["cosine"] - x @ y / math.sqrt((x @ x) * (y @ y))) < 1e-6
    assert table.nearest("nothing").count() == 0


def test_same_seed_same_vectors_whatever_the_partitions(spark):
    df = spark.createDataFrame(planted(200), "comment array<string>")
    one, two = (rows_of(fit_word_table(df.repartition(k), **SMALL)) for k in (1, 5))
    assert one == two and len(one) == 40 + 6 * 6
    assert rows_of(fit_word_table(df, **{**SMALL, "seed": 6})) != one


def test_a_stopped_fit_goes_on(spark, tmp_path):
    df = spark.createDataFrame(planted(200), "comment array<string>")
    path = str(tmp_path / "fit")
    assert fit_word_table(df, path=path, stop_after=4, **SMALL) is None
    again = fit_word_table(df, path=path, **SMALL)
    assert rows_of(again) == rows_of(fit_word_table(df, **SMALL))
    left = [p.name for p in (tmp_path / "fit").iterdir() if p.name.startswith("step=")]
    assert sorted(left) == ["step=5", "step=6"]
    with pytest.raises(ValueError):
        fit_word_table(df, path=path, **{**SMALL, "seed": 9})


def test_gradient_follows_the_objective():
    rng = np.random.default_rng(0)
    u, v = rng.normal(size=(5, 4)).astype(np.float32), rng.normal(size=(6, 4)).astype(np.float32)
    i, j = np.repeat(np.arange(5), 6), np.tile(np.arange(6), 5)
    w = rng.random(30).astype(np.float32)

    def loss():
        return float((w * np.log1p(np.exp(-np.einsum("ij,ij->i", u[i], v[j])))).sum())

    before = loss()
    for t in range(30):
        learn_block(u, np.zeros(5, np.float32), np.ones(5), v, np.zeros(6, np.float32), np.ones(6), i, j, w, 0.0, 0, 0.02, t)
    assert loss() < 0.7 * before


def test_hot_word_rare_words_and_no_words(spark):
    # A word that is half of everything, and blocks cut in several slices by a small bound on words.
    rows = [(["hot", f"w{i % 50}", "hot", "hot"],) for i in range(300)] + [([f"once{i}"],) for i in range(5)]
    df = spark.createDataFrame(rows, "comment array<string>")
    table = fit_word_table(df, dim=4, epochs=1, min_buckets=2, words_per_bucket=10)
    vec = rows_of(table)
    assert len(vec) == 56 and all(np.isfinite(v).all() for v in vec.values())
    assert set(rows_of(fit_word_table(df, dim=4, epochs=1, min_buckets=2, min_count=2))) == {"hot"} | {f"w{i}" for i in range(50)}
    none = fit_word_table(spark.createDataFrame([([],), (None,)], "comment array<string>"), dim=4)
    assert none.getVectors().count() == 0
    assert none.transform(df.limit(1)).first()["result"].toArray().tolist() == [0.0] * 4


def test_mean_vectors_save_and_load(spark, tmp_path):
    df = spark.createDataFrame(planted(60), "comment array<string>")
    table = fit_word_table(df, dim=4, epochs=1, min_buckets=2)
    vec = rows_of(table)
    table.save(str(tmp_path / "saved"))
    back = WordTable.load(spark, str(tmp_path / "saved"))
    assert rows_of(back) == vec and (back.dim, back.input_col) == (4, "comment")
    probe = spark.createDataFrame([(1, ["left0", "unknown", "left0"]), (2, []), (3, None), (4, ["left0", "unknown", "left0"])],
                                  "k long, comment array<string>")
    got = {r["k"]: r["result"].toArray() for r in back.transform(probe).collect()}
    assert np.allclose(got[1], np.array(vec["left0"]) * 2 / 3) and (got[1] == got[4]).all()
    assert not got[2].any() and not got[3].any()


def test_classifier_on_a_word_table(spark, tmp_path):
    from brandpulse.operators.model import SentimentModel, fit_sentiment

    rng = random.Random(2)
    rows = [([rng.choice(["good", "fine", "nice"] if i % 2 else ["bad", "poor", "sad"]) for _ in range(5)], i % 2) for i in range(300)]
    train = spark.createDataFrame(rows, "comment array<string>, sentiment int")
    model = fit_sentiment(train, vector_size=6, vectors="table", seed=4, min_buckets=2)
    probe = spark.createDataFrame([(1, ["good", "nice"]), (0, ["sad", "poor", "bad"])], "y int, comment array<string>")
    assert all(r["y"] == r["prediction"] for r in model.predict(probe).collect())
    model.save(str(tmp_path / "model"))
    back = SentimentModel.load(spark, str(tmp_path / "model"))
    assert isinstance(back.w2v, WordTable) and back.weights == model.weights
    assert all(r["y"] == r["prediction"] for r in back.predict(probe).collect())
    with pytest.raises(ValueError):
        fit_sentiment(train, vectors="other")


def test_pairs_are_moved_as_packed_rows_and_once(spark):
    words = [f"w{k % 37}é" for k in range(900)]
    rows = spark.createDataFrame([(words[k:k + 30],) for k in range(0, 900, 30)] * 2, "t array<string>").repartition(3)
    pairs = word_pairs(rows, "t", 3, 12)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(part" in plan
    want = Counter()
    for k in list(range(0, 900, 30)) * 2:
        for lo in range(0, 30, 12):
            run = words[k:k + 30][lo:lo + 12]
            for d in (1, 2, 3):
                for x, y in zip(run[:-d], run[d:]):
                    want[min(x, y), max(x, y)] += 4 - d
    got = pairs.collect()
    assert len(got) == len(want) and {(r["a"], r["b"]): r["n"] for r in got} == dict(want)
