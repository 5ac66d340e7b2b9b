"""Line dedup, quality rules, source mixing and exact search against plain Python, with odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brandpulse.llm import line_dedup, mixing, quality, topk

AZ = re.compile("[A-Z]")


def lower(t):
    return AZ.sub(lambda m: m[0].lower(), t)


def line_key(x):
    return lower(x.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows):
    held = {}
    for i, (d, t) in enumerate(rows):
        for k in {line_key(x) for x in (t or "").split("\n")}:
            held.setdefault(k, set()).add(i)
    rank = lambda d: -(2 ** 63) if d is None else d
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(line_key(x)) >= 20 and len(held[line_key(x)]) >= 3
                                         and rank(d) < max(rank(rows[i][0]) for i in held[line_key(x)]))]
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup(spark):
    rng = random.Random(1)
    shared = [f"  Shared LINE number {i} é{'x' * i}\t" for i in range(12)] + ["short line", "exactly twenty chars"]
    rows = [(i, "\n".join(rng.choice(shared) if rng.random() < 0.5 else f"own line {i} {rng.random()}"
                          for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(None, "exactly twenty chars\nEXACTLY TWENTY CHARS "), (70, None), (71, ""), (72, "\n\n"), (73, "exactly twenty chars"),
             (73, "exactly twenty chars"), (74, "x" * 200_000), (75, "a\r\n" * 5000)]
    docs = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, n_lines int").repartition(3)
    got = line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(rows)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def brute_statistics(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics_and_verdict(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a b c a b c", "x\ny\nx \nx", "é #1 | 日本 <b>", "same same same same", "|" * 3000]
    texts += [rng.choice(["\n", " "]).join(rng.choice(["a", "bb", "#c", "d\n", "é|"]) for _ in range(rng.randint(0, 80)))
              for _ in range(60)]
    good = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(60)) for _ in range(120)]
    junk = [" ".join(f"w{rng.randint(0, 999)}###$$$" for _ in range(60)) for _ in range(30)]
    rows = list(enumerate(texts + good + junk))
    docs = spark.createDataFrame([(d, t, True) for d, t in rows], "doc_id long, text string, kept boolean").repartition(3)
    labels = spark.createDataFrame(
        [(d, int(t in set(good))) for d, t in rows[len(texts)::2]] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    for d, t in rows:
        r, want = got[d], brute_statistics(t)
        assert tuple(r[c] for c in quality.COUNTS) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    kept = lambda some: sum(got[d].kept for d, t in rows if t in set(some))
    assert kept(good) >= 0.95 * len(good) and kept(junk) <= 0.2 * len(junk)
    assert quality.quality_rules(docs, labels.limit(0)).where("kept AND n_symbols > 0").count() >= len(junk)  # no labels: the base rules alone
    assert quality.quality_rules(docs.limit(0), labels).count() == 0


def test_source_targets_and_mix(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), rng.choice(["a", "b", "hot", "hot", "hot", None, "Z", "é"]))
            for i in range(600)]
    rows += [(700, "w " * 4000, "a"), (701, None, "b"), (702, "", None), (703, "x y", "tiny"), (704, "x y", "tiny"), (704, "x y", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix_sources(docs, block_rows=16)
    got = out.collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted((d, len((t or "").split())) for d, t, _ in rows)
    sources = sorted({s for _, _, s in rows if s is not None}) + [None]
    own = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while open_:
        level = (sum(own.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * own[s]}
        target |= {s: 3.0 * own[s] for s in over} if over else {s: level * weight[s] for s in open_}
        open_ = open_ - over if over else set()
    for r in got:
        assert r.source_size == own[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.copies <= 3 and (r["size"] > 0 or r.copies == 0)
    for s in sources:
        taken = sum(r["size"] * r.copies for r in got if r.source == s)
        biggest = max(r["size"] for r in got if r.source == s)
        assert abs(taken - target[s]) <= max(biggest, 1), s
    again = mixing.mix_sources(docs.repartition(7), block_rows=16).collect()
    key = lambda rs: sorted((r.doc_id, r.source or "", r.copies) for r in rs)
    assert key(again) == key(got)
    applied = mixing.apply_mix(docs, out)
    assert applied.columns == docs.columns and applied.count() == sum(r.copies for r in got)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_pivot_keeps_mass_and_expectation():
    rng = random.Random(5)
    size, part = [float(rng.randint(1, 30)) for _ in range(20)], [rng.random() for _ in range(20)]
    mean = np.zeros(20)
    for _ in range(4000):
        out, at = mixing.pivot(size, part, [rng.random() for _ in size])
        assert sum(a * b for a, b in zip(size, out)) == pytest.approx(sum(a * b for a, b in zip(size, part)))
        assert all(0 <= p <= 1 for p in out) and sum(0 < p < 1 for p in out) <= 1
        mean += np.array(out) / 4000
    assert np.abs(mean - part).max() < 0.05


def brute_top(rows, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    out = set()
    for q in vectors:
        if q % 5:
            continue
        mine = min(vectors[q])
        scored = sorted({(-sum(a * b for a, b in zip(mine, v)), i) for i, vs in vectors.items() if i != q for v in vs})[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)}
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 4)
    rng = random.Random(7)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.5, 1.0]) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (None, [1.0] * 6), (201, [float("nan")] + [1.0] * 5), (202, [None] + [1.0] * 5),
             (203, [float("inf")] * 6), (204, []), (205, [9.0, 9.0]), rows[3], rows[10]]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = topk.top_k(vectors, lambda i: i % 5 == 0, k=4).collect()
    assert {tuple(r) for r in got} == brute_top(rows, 4) and len(got) == len({tuple(r) for r in got})
    few = vectors.where("vec_id < 3")
    assert {tuple(r) for r in topk.top_k(few, lambda i: i % 5 == 0, k=4).collect()} == brute_top(rows[:3], 4)
    assert topk.top_k(vectors.limit(0), lambda i: i % 5 == 0).count() == 0


def test_quality_fit_weighs_every_labelled_row(spark, monkeypatch):
    # More labelled rows than the fit once took, two of them repeated, one with a text too short for the base rules.
    n, seen = 20_500, []
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), i * 7919 % (F.col("id") % 97 + 61), F.lit("_"), i)), " ").alias("text"))
    docs = docs.unionByName(docs.limit(2)).unionByName(spark.createDataFrame([(n, "short")], "doc_id long, text string"))
    labels = spark.range(n + 1).select(F.col("id").alias("doc_id"), (F.col("id") % 4 > 0).cast("int").alias("quality"))
    kept = quality.threshold_of
    monkeypatch.setattr(quality, "threshold_of", lambda bins, good, bad: seen.append((good.sum(), bad.sum())) or kept(bins, good, bad))
    forest = quality.fit_quality(docs, labels)
    assert seen == [(n * 3 // 4, n // 4)] and 0 < forest.threshold <= 1
    again = quality.fit_quality(docs.repartition(5), labels)
    assert again.threshold == forest.threshold and (again.value == forest.value).all()


def test_threshold_is_the_cheapest_bin():
    bins, good, bad = np.array([30, 10, 20]), np.array([0, 5, 1]), np.array([7, 0, 12])
    assert quality.threshold_of(bins, good, bad) == 15.5 / quality.BINS      # 12 bad rows cost more than a good one
    assert quality.threshold_of(bins, good, bad - [0, 0, 3]) == 25.5 / quality.BINS
    assert quality.threshold_of(bins, good * 0, bad) == math.inf
    edge = np.array([1, 2, 3]) / quality.BINS
    assert quality.score_bins(edge).tolist() == [0, 1, 2] and quality.score_bins(edge + 1e-9).tolist() == [1, 2, 3]


def test_top_k_never_broadcasts_blocks(spark, monkeypatch):
    # Copies of blocks are not in the optimizer's estimate; a broadcast of them would stand whole on the driver.
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(topk, "FREE_BLOCKS", 3)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5]) for _ in range(3)]) for i in range(90)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 5 == 0, k=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 3)
