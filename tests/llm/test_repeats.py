"""Suffix-array and substring dedup against counting every window in plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brandpulse.llm import common, repeats
from brandpulse.llm.substring_dedup import substring_dedup
from brandpulse.llm.suffix_dedup import suffix_dedup


def brute(units_of, join, texts, window):
    units = [units_of(t) for t in texts]
    seen = Counter(tuple(u[i:i + window]) for u in units for i in range(len(u) - window + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - window + 1):
            if seen[tuple(u[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(u), sum(gone), spans, hashlib.sha256(join([x for x, g in zip(u, gone) if not g])).hexdigest()))
    return out


def as_bytes(texts, window):
    return brute(lambda t: list((t or "").encode()), bytes, texts, window)


def as_words(texts, window):
    return brute(lambda t: [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")], b" ".join, texts, window)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    say = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    shared = [say(40) for _ in range(4)]
    texts = [None, "", "a", "ab " * 90, "x" * 300, "x" * 250 + "y" + "x" * 250, " \t\n"]
    for _ in range(n):
        parts = [say(rng.randint(0, 30))]
        if rng.random() < 0.8:
            parts += [rng.choice(shared)[rng.randint(0, 40):], say(rng.randint(0, 20))]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    texts += [texts[-1], texts[-2], texts[-1][5:]]
    return texts


@pytest.mark.parametrize("hot,small", [(512, False), (512, True), (3, True)])
@pytest.mark.parametrize("seed", [1, 2])
def test_both_equal_brute_force(spark, seed, hot, small, monkeypatch):
    if small:       # texts and packed strings in many slices, groups carried over batch boundaries
        monkeypatch.setattr(common.slices, "__defaults__", ("_t", 700))
        monkeypatch.setattr(repeats, "BUCKET_BYTES", 500)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    docs = docs.repartition(3)
    got = (suffix_dedup(docs, length=40, gram=8, hot=hot)
           .select("doc_id", "n_units", "n_removed", F.size("removed"), F.sha2("kept", 256)).orderBy("doc_id").collect())
    assert [tuple(r)[1:] for r in got] == as_bytes(texts, 40)
    got = (substring_dedup(docs, window=7, gram=3, hot=hot)
           .select("doc_id", "n_units", "n_removed", F.size("removed"), F.sha2("kept", 256)).orderBy("doc_id").collect())
    assert [tuple(r)[1:] for r in got] == as_words(texts, 7)


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, t), (1, t), (None, t + " x"), (None, None)], "doc_id long, text string")
    got = substring_dedup(docs, window=5, gram=2).select("doc_id", "n_removed", F.col("kept").cast("string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 10, ""), (1, 10, ""), (None, 10, "x"), (None, 0, "")], key=str)
    for op in (suffix_dedup, substring_dedup):
        assert op(docs.limit(0)).count() == 0


def test_patterns_that_collide_in_sums_modulo_a_power_of_two(spark):
    pattern = [0]
    while len(pattern) < 4096:
        pattern += [1 - x for x in pattern]
    word = lambda n, k: "".join("ab"[x ^ k] for x in pattern[:n])
    texts = [" ".join(["one", word(n, k), *"c d e f g h i j".split()]) for n in (1024, 4096) for k in (0, 1)]
    texts += [" ".join("uv"[x ^ k] for x in pattern[:2048]) for k in (0, 1)] + [word(1024, 0), word(1024, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = (substring_dedup(docs, window=35, gram=5).select("doc_id", "n_units", "n_removed", F.size("removed"), F.sha2("kept", 256))
           .orderBy("doc_id").collect())
    assert [tuple(r)[1:] for r in got] == as_words(texts, 35)
    got = (substring_dedup(docs, window=7, gram=3).select("doc_id", "n_units", "n_removed", F.size("removed"), F.sha2("kept", 256))
           .orderBy("doc_id").collect())
    assert [tuple(r)[1:] for r in got] == as_words(texts, 7)
    got = suffix_dedup(docs).select("doc_id", "n_units", "n_removed", F.size("removed"), F.sha2("kept", 256)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == as_bytes(texts, 400)
