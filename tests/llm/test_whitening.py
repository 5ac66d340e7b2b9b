"""Whitening against numpy on whole-number arithmetic, with odd vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from brandpulse.llm import queries, whitening


def plain(vectors, components=8):
    """Exact deviations, and whitened rows (up to sign) of the remaining vectors."""
    keep = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in keep), default=0)
    x = [[math.floor(1024 * float(c)) + 100_000 for c in list(v) + [0.0] * (dim - len(v))] for _, v in keep]
    n, s = len(x), [sum(col) for col in zip(*x)]
    dev = [sum((n * c - t) ** 2 for c, t in zip(row, s)) for row in x]
    off = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(row, s)] for row in x])
    cov = off.T @ off / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return [i for i, _ in keep], n, dev, off @ u / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(cov)


def data(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dim, dim)) * np.geomspace(spread, spread / 50, dim)
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(rng.normal(size=(n, dim)) @ mix + 3.0)]


def check(spark, vectors, components=8):
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in vectors], "vec_id long, embedding array<float>, n int, _row string").repartition(4)
    got = whitening.whiten(df, components=components).collect()
    ids, n, dev, white, explained = plain(vectors, components)
    got.sort(key=lambda r: (str(r[0]), r["deviation"], r["whitened"]))
    order = sorted(range(len(ids)), key=lambda j: (str(ids[j]), dev[j]))
    assert [r[0] for r in got] == [ids[j] for j in order]
    assert [int(r["deviation"]) for r in got] == [dev[j] for j in order] and {r["n"] for r in got} == {n}
    w, want = np.array([r["whitened"] for r in got], float), white[order]
    sign = np.sign((w * want).sum(0))
    assert np.allclose(w, want * sign, atol=1e-6)
    assert np.allclose(np.array(got[0]["explained"]), explained, rtol=1e-9)
    assert got[0]["identity_error"] < 1e-8
    return got


def test_random_vectors_and_odd_rows(spark):
    rows = data(1, 700, 12, 0.4)
    rows += [(None, rows[3][1]), (900, None), (901, [float("nan")] * 12), (902, [1.0] * 11 + [float("inf")]),
             (903, [None] + [0.5] * 11), (5, rows[5][1]), (5, rows[5][1]), (904, [0.25] * 4)]
    check(spark, rows)


def test_many_blocks_and_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 64 * 8 * 5)
    monkeypatch.setattr(whitening, "BLOCK_COLS", 5)
    check(spark, data(2, 500, 13, 0.3), components=6)


def test_large_values_use_decimals(spark):
    rows = [(i, [float(np.float32(c * 3e5)) for c in v]) for i, v in data(3, 300, 5, 2.0)]
    assert max(plain(rows)[2]) > 2 ** 63
    check(spark, rows)


def test_no_variance_no_rows(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    for r in whitening.whiten(one).collect():
        assert r["deviation"] == 0 and r["whitened"] == [None, None] and r["explained"] == [None, None] and r["identity_error"] is None
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whitening.whiten(flat).collect()
    assert all(r["whitened"][0] is not None and r["whitened"][1] is None for r in got) and got[0]["identity_error"] < 1e-9
    assert whitening.whiten(one.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>")).count() == 0


def test_query_on_table(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_embedding_whitening"](spark, sf)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    ids, n, dev, white, explained = plain([tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()])
    rows = got.collect()
    assert len(rows) == 8 * n and {(r["vec_id"], r["deviation"]) for r in rows} == set(zip(ids, dev))
    for k in range(8):
        mine = {r["vec_id"]: r for r in rows if r["component"] == k + 1}
        w = np.array([mine[i]["whitened"] for i in ids])
        assert np.allclose(w, white[:, k] * np.sign(w @ white[:, k]), atol=1e-6)
        assert all(r["explained"] == pytest.approx(explained[k], rel=1e-9) and r["identity_error"] < 1e-8 for r in mine.values())
