"""Dual ascent: same optimum as Spark ML's LinearSVC, in few jobs, whatever the partitions."""

import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from brandpulse.operators.dual import hinge_dual

REG = 0.01


def objective(x, y, w):
    return float(np.maximum(0, 1 - y * (x @ w)).mean() + REG / 2 * w @ w)


def test_same_optimum_as_linearsvc_in_few_jobs(spark):
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = emb.select(F.col("embedding").cast("array<double>").alias("x"), (F.col("label") % 2).cast("double").alias("y")).repartition(4)
    rows = rows.persist()
    x = np.array([r["x"] for r in rows.collect()])
    y = 2 * np.array([r["y"] for r in rows.collect()]) - 1
    fit = hinge_dual(rows, "x", "y", 64, REG)
    assert fit.rounds <= 13 and 0 <= fit.gap <= 1e-3 * fit.objective
    assert abs(objective(x, y, np.array(fit.weights)) - fit.objective) < 1e-9
    svc = LinearSVC(maxIter=200, regParam=REG, fitIntercept=False, standardization=False).fit(
        rows.select(array_to_vector("x").alias("features"), F.col("y").alias("label")))
    assert abs(fit.objective - objective(x, y, svc.coefficients.toArray())) < 1e-3
    close = hinge_dual(rows.repartition(7), "x", "y", 64, REG, tolerance=1e-5)
    assert close.gap <= 1e-5 * close.objective and fit.objective - close.objective <= fit.gap
    rows.unpersist()


def test_odd_rows(spark):
    none = spark.createDataFrame([], "x array<double>, y double")
    assert hinge_dual(none, "x", "y", 3, REG).weights == [0.0, 0.0, 0.0]
    zeros = spark.createDataFrame([([0.0, 0.0], 1.0), ([0.0, 0.0], 0.0)], "x array<double>, y double")
    fit = hinge_dual(zeros, "x", "y", 2, REG)
    assert fit.weights == [0.0, 0.0] and fit.objective == 1.0 and fit.gap <= 1e-3
    # A third of the rows are one row; the same rows in any blocks give the same optimum.
    many = spark.createDataFrame([([1.0, 0.1 * (i % 9)], float(i % 3 > 0)) for i in range(200)] + [([1.0, 0.5], 1.0)] * 100,
                                 "x array<double>, y double")
    a, b = (hinge_dual(many.repartition(k), "x", "y", 2, REG, tolerance=1e-6) for k in (1, 6))
    assert abs(a.objective - b.objective) < 1e-5


def test_dual_variables_stay_off_the_driver_and_blocks_depend_on_the_rows(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from brandpulse.operators import dual

    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(self.columns) or collect(self))
    monkeypatch.setattr(dual, "BLOCK_ROWS", 64)
    rows = spark.createDataFrame([([1.0, 0.1 * (i % 9), 0.01 * i], float(i % 3 > 0)) for i in range(300)], "x array<double>, y double")
    a, b = (hinge_dual(rows.repartition(k), "x", "y", 3, REG, parts=3) for k in (1, 5))
    assert a == b and a.gap <= 1e-3 * a.objective
    assert seen and not [c for c in seen if {"alpha", "x"} & set(c)]
