"""Quality classifier: n-grams, dual descent and sigmoid against plain loops, held-out accuracy, odd rows."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from brandpulse.llm import nbsvm, queries

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def cells(texts, buckets=nbsvm.BUCKETS):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    text, bucket = nbsvm.grams(np.frombuffer(b"".join(raw), np.uint8), off, buckets)
    return [bucket[text == i] for i in range(len(texts))]


def plain_shape(words, i):
    w = words[i].encode()
    upper, lower = sum(65 <= b <= 90 for b in w), sum(97 <= b <= 122 for b in w)
    case = (0 if not upper + lower else 1 if not upper else 2 if upper == 1 and 65 <= w[0] <= 90 and len(w) > 1
            else 3 if not lower else 4)
    same = i > 0 and re.sub("[A-Z]", lambda m: m[0].lower(), words[i]) == re.sub("[A-Z]", lambda m: m[0].lower(), words[i - 1])
    last = w[-1] if chr(w[-1]) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else 0
    return case, min(len(w) // 4, 4), same, last


def plain_grams(t):
    words = SPACE.findall(t)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    shapes = [plain_shape(words, i) for i in range(len(words))]
    return {("w", *low[i:i + n]) for n in (1, 2) for i in range(len(low) - n + 1)} | {
        ("s", *shapes[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def test_grams_are_the_distinct_ngrams():
    rng = random.Random(1)
    words = ["The", "the", "THE", "été!", "x", "a|", "12,", "ABc", "日本", "word###", "I"]
    texts = ["", "  \n", "x", *[rng.choice([" ", "\n\t"]).join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(80)]]
    seen = {}
    for t, got in zip(texts, cells(texts, 1 << 40)):
        want = plain_grams(t)
        assert len(got) == len(want)          # 2**40 buckets: no two n-grams share one
        for g in want:
            one = seen.setdefault(g, set(got.tolist()))
            seen[g] = one & set(got.tolist())
    assert all(seen.values())                 # an n-gram has the same bucket in every text that holds it


def junk(rng):
    return " ".join(f"w{rng.randint(0, 99)}{rng.choice(['###', '$$$', '%%%'])}" for _ in range(rng.randint(20, 60)))


def prose(rng):
    return " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(20, 60))).capitalize() + "."


def test_dual_descent_solves_the_hinge_problem():
    rng = random.Random(2)
    texts = [(junk if i % 3 == 0 else prose)(rng) for i in range(90)]
    rows = cells(texts, 512)
    y = np.array([-1.0 if i % 3 == 0 else 1.0 for i in range(90)])
    y[::17] *= -1
    count = lambda side: np.bincount(np.concatenate([r for r, s in zip(rows, y) if s == side]), minlength=512).astype(float)
    good, bad = count(1.0), count(-1.0)
    ratio = nbsvm.log_count_ratio(good, bad)
    for b in range(512):
        want = math.log((good[b] + 1) / (good.sum() + 512)) - math.log((bad[b] + 1) / (bad.sum() + 512)) if good[b] + bad[b] else 0
        assert ratio[b] == pytest.approx(want, abs=1e-12)
    w, bias, alpha = nbsvm.dual_descent(rows, y, ratio, epochs=2000, tolerance=1e-6)
    x = np.zeros((90, 513))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.linalg.norm(ratio[r])
        x[i, 512] = 1.0
    full = np.append(w, bias)
    assert np.allclose(full, (alpha * y) @ x)                      # the primal point of the dual variables
    primal = 0.5 * full @ full + np.maximum(0, 1 - y * (x @ full)).sum()
    dual = alpha.sum() - 0.5 * full @ full
    assert 0 <= alpha.min() and alpha.max() <= 1 and primal - dual < 1e-3 * primal


def test_sigmoid_fits_shares():
    rng = np.random.default_rng(3)
    m = rng.normal(size=20_000) * 2
    label = rng.random(20_000) < 1 / (1 + np.exp(-(1.5 * m - 0.7)))
    slope, shift = nbsvm.fit_sigmoid(m, label)
    assert slope == pytest.approx(1.5, abs=0.1) and shift == pytest.approx(-0.7, abs=0.1)


def test_scores_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, (junk if i % 4 == 0 else prose)(rng)) for i in range(400)]
    truth = {i: int(i % 4 != 0) for i, _ in rows}
    odd = [(None, "word " * 30), (500, None), (501, ""), (502, " \n"), (503, prose(rng) * 3000), (7, rows[7][1]), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows + odd], "doc_id long, text string, _y string, score double").repartition(3)
    marks = [(i, q, "z") for i, q in truth.items()] + [(None, 1, "z"), (3, None, "z"), (500, 0, "z"), (9, 1, "z"), (9, 1, "z")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, text string")
    out = nbsvm.quality_scores(docs, labels, carry=["score"])
    assert out.columns == ["doc_id", "score", "held_out", "score", "predicted"]
    got = nbsvm.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 < r.score < 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    again = sorted((r.doc_id or -1, r.score) for r in nbsvm.quality_scores(docs.repartition(5), labels).collect())
    assert again == sorted((r.doc_id or -1, r.score) for r in got)
    # Held-out labels are never learnt from: turning them all round changes no score.
    turned = spark.createDataFrame([(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 4 == 2 else q, z)
                                    for i, q, z in marks], labels.schema)
    assert sorted((r.doc_id or -1, r.score) for r in nbsvm.quality_scores(docs, turned).collect()) == again
    assert {r.score for r in nbsvm.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert nbsvm.quality_scores(docs.limit(0), labels).count() == 0


def test_fit_is_bounded(spark):
    rng = random.Random(5)
    rows = [(i, (junk if i % 2 else prose)(rng)) for i in range(300)]
    docs = spark.createDataFrame(rows * 2 + [(1, prose(rng))] * 5, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    chosen = nbsvm.chosen_labels(labels, "doc_id", "quality", 100)
    assert 90 <= chosen.count() <= 100
    small = nbsvm.fit_classifier(docs, labels, max_fit_rows=100, max_fit_cells=4000)
    assert np.isfinite(small.weight).all() and (small.square > 0).sum() <= 4000


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op12_quality_classifier"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    assert right > 0.95 and right > np.mean([r.quality for r in rows]) + 0.05
