"""Sentiment model: word vectors + linear classifier.

Word vectors (M1) are learned part by part and averaged, as Spark ML's ``Word2Vec`` does it but with no vocabulary on the
driver (``operators.word_parts``); then come the document vectors of the training rows (M2) and
the linear classifier (M5: hinge loss + L2) in few jobs, by dual ascent inside partitions (``operators.dual``).
``trainer="linearsvc"`` solves the same problem with Spark ML's L-BFGS, a job a step, and ``trainer="sgd"`` keeps the
reference's optimiser, full-batch hinge-loss steps (``hinge_sgd``). ``vectors="table"`` learns the
word vectors over partitioned tables of word pairs instead (``operators.word_table``).

Scoring (M2 + M6) has one path at every size. The classifier is linear and a document vector is the mean of
its word vectors, so the classifier is folded into the words: ``s(word) = w . v(word)``, one DOUBLE for each
word, and ``margin = intercept + mean of s over all tokens`` (unknown words count as 0, as they do in the
mean). Tokens are exploded under a compact key and joined to the word scores: 8 bytes for each token instead
of a vector, no array in the shuffle. The score table is broadcast only behind a measured size; a larger one
meets the lists part by part (``operators.token_parts``), with the same result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.operators.dual import hinge_dual, packed_blocks
from brandpulse.operators.scoring import error_rate
from brandpulse.operators.token_parts import list_key, list_sums, written_lists
from brandpulse.operators.word_parts import PartWord2Vec
from brandpulse.operators.word_table import WordTable, fit_word_table
from brandpulse.session import written

# Reference settings (fixed values): vector size 128, minimum count 0, 200 iterations.
VECTOR_SIZE = 128
MIN_COUNT = 0
SVM_ITERATIONS = 200
# Library defaults the reference relied on for its SGD trainer.
SGD_STEP = 1.0
SGD_REG = 0.01
SGD_TOLERANCE = 0.001

# The driver builds a broadcast table: some ten times these bytes, and a query may hold several.
DEFAULT_MAX_BROADCAST_BYTES = 2 * 1024 * 1024
# Parts of the word vectors' text, at least, and rows of a part of the classifier's. The fit's result depends on them, so they
# are never taken from the cluster.
TRAIN_PARTITIONS = 4
ROWS_PER_PART = 60_000


@dataclass
class SentimentModel:
    """A fitted word-vector model and linear classifier."""

    w2v: WordTable | Word2VecModel           # the latter from a folder saved by an earlier version
    weights: list[float] | None = None      # set for trainer="dual" and "sgd"
    intercept: float = 0.0
    svc: LinearSVCModel | None = None        # set for trainer="linearsvc"
    input_col: str = "comment"
    features_col: str = "result"

    def vectors(self, df: DataFrame) -> DataFrame:
        """M2: add the document vector column (``transform`` of the word vectors; for training and samples)."""
        return self.w2v.transform(df)

    def linear(self) -> tuple[list[float], float]:
        """Weights and intercept of the classifier, whichever trainer made it."""
        if self.svc is not None:
            return [float(x) for x in self.svc.coefficients.toArray()], float(self.svc.intercept)
        return list(self.weights), float(self.intercept)

    def predict(self, df: DataFrame, prediction_col: str = "prediction", **kw) -> DataFrame:
        """M2 + M6: 0/1 prediction (INT) for each row's token array."""
        weights, intercept = self.linear()
        scores = word_scores(self.w2v.getVectors(), weights)
        margin = token_margins(df, self.input_col, scores, intercept, "_margin", **kw)
        return margin.withColumn(prediction_col, (F.col("_margin") > 0).cast("int")).drop("_margin")

    def save(self, path: str) -> None:
        """K6 + K7: persist both parts under one folder (new path, never in place)."""
        vectors = "table" if isinstance(self.w2v, WordTable) else "word2vec"
        if vectors == "table":
            self.w2v.save(f"{path}/word2vec")
        else:
            self.w2v.write().overwrite().save(f"{path}/word2vec")
        spark = self.w2v.getVectors().sparkSession
        kind = "linearsvc" if self.svc is not None else "sgd"
        spark.createDataFrame([(kind, vectors)], "trainer string, vectors string").write.mode("overwrite").json(f"{path}/kind")
        if self.svc is not None:
            self.svc.write().overwrite().save(f"{path}/classifier")
        else:
            spark.createDataFrame([(list(self.weights), float(self.intercept))], "weights array<double>, intercept double") \
                .write.mode("overwrite").parquet(f"{path}/sgd_weights")

    @staticmethod
    def load(spark, path: str) -> "SentimentModel":
        """S5 + S6: load a model saved by ``save``."""
        kind = spark.read.schema("trainer string, vectors string").json(f"{path}/kind").first()
        if kind["vectors"] == "table":
            w2v = WordTable.load(spark, f"{path}/word2vec")
            cols = dict(w2v=w2v, input_col=w2v.input_col, features_col=w2v.features_col)
        else:
            w2v = Word2VecModel.load(f"{path}/word2vec")
            cols = dict(w2v=w2v, input_col=w2v.getInputCol(), features_col=w2v.getOutputCol())
        if kind["trainer"] == "linearsvc":
            return SentimentModel(svc=LinearSVCModel.load(f"{path}/classifier"), **cols)
        row = spark.read.parquet(f"{path}/sgd_weights").first()
        return SentimentModel(weights=list(row["weights"]), intercept=row["intercept"], **cols)


def linear_margin(features: Column, weights: list[float], intercept: float = 0.0) -> Column:
    """M6 scalar form: ``intercept + sum_i w_i * x_i`` as a native array expression."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    products = F.zip_with(features.cast("array<double>"), w, lambda x, y: x * y)
    return F.aggregate(products, F.lit(float(intercept)), lambda acc, v: acc + v)


def _as_array(vectors: DataFrame, vector_col: str) -> Column:
    return F.col(vector_col) if dict(vectors.dtypes)[vector_col].startswith("array") else vector_to_array(vector_col)


def word_scores(vectors: DataFrame, weights: list[float], word_col: str = "word", vector_col: str = "vector") -> DataFrame:
    """The classifier folded into the words: ``(_w, _s DOUBLE)`` with ``_s = weights . vector``."""
    return vectors.select(F.col(word_col).alias("_w"), linear_margin(_as_array(vectors, vector_col), weights).alias("_s"))


def _fits(table: DataFrame, row_bytes: Column, max_bytes: int) -> bool:
    """Whether the measured size allows a broadcast; otherwise values go to the parts that need them (``token_parts``)."""
    return (table.agg(F.sum(row_bytes)).first()[0] or 0) <= max_bytes


def _once(table: DataFrame, values: list[Column]) -> DataFrame:
    """``(_w, _v)`` with a word once: its rows' values summed, and as the last value how often the word is repeated (a token
    meets every row of its word, and its mean counts them all)."""
    sums = [F.sum(F.coalesce(v, F.lit(0.0))) for v in values]
    return table.groupBy("_w").agg(F.array(*sums, (F.count("*") - 1).cast("double")).alias("_v"))


def token_margins(df: DataFrame, tokens_col: str, scores: DataFrame, intercept: float, out_col: str = "margin",
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``out_col``: ``intercept + mean over all tokens of the word's score`` (unknown: 0).

    Rows meet their margin by the 128-bit hash of the token list, so equal token lists share one margin: the
    mean over the token rows of a key is the same however many rows hold that list. An empty list has the
    intercept, a null one too. Token rows carry the key and the word only, and scores are broadcast behind a measured
    bound; beyond it the rows are written once and a part of the lists gets the scores of its own words (``list_sums``).
    """
    # Hashes are never null, so no null check (which would run the tokens' expression again) is inferred.
    key = list_key(tokens_col)
    keyed = df.withColumns(key)
    if _fits(scores, F.octet_length("_w") + 24, max_broadcast_bytes):
        toks = keyed.select(*key, F.explode_outer(tokens_col).alias("_w"))
        means = toks.join(F.broadcast(scores), "_w", "left").groupBy(*key).agg(
            (F.lit(float(intercept)) + F.avg(F.coalesce("_s", F.lit(0.0)))).alias(out_col))
    else:
        columns = keyed.columns
        rows = written_lists(keyed, tokens_col)
        sums, keyed = list_sums(rows, tokens_col, _once(scores, [F.col("_s")]), 2), rows.select(*columns)
        means = sums.select(*key, (F.lit(float(intercept)) + F.col("_sum")[0] / (F.greatest("_n", F.lit(1)) + F.col("_sum")[1])).alias(out_col))
    return keyed.join(means, list(key), "left").drop(*key)


def doc_vectors(df: DataFrame, tokens_col: str, vectors: DataFrame, key_cols: list[str], dim: int,
                out_col: str = "result", word_col: str = "word", vector_col: str = "vector",
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """M2 by join: ``(key..., out_col)``, the mean of the known word vectors over *all* tokens of a key.

    Unknown tokens count in the denominator, an empty document is all zeros (the ``Word2VecModel.transform``
    rule). Rows with equal keys hold equal tokens or are taken as one document. ``vectors`` is (word, vector)
    with a Spark ML vector or an array, of any size; for classifying, ``token_margins`` moves 8 bytes a token.
    """
    vec = vectors.select(F.col(word_col).alias("_w"), _as_array(vectors, vector_col).alias("_v"))
    if not _fits(vec, F.octet_length("_w") + 8 * dim + 40, max_broadcast_bytes):
        keyed = df.select(*key_cols, F.col(tokens_col).alias("_t")).withColumns(list_key("_t"))
        sums = list_sums(keyed, "_t", _once(vec, [F.col("_v")[i] for i in range(dim)]), dim + 1)
        per = keyed.select(*key_cols, "_k1", "_k2").join(sums, ["_k1", "_k2"], "left").groupBy(*key_cols).agg(
            F.sum(F.greatest("_n", F.lit(1)) + F.col("_sum")[dim]).alias("_n"), *[F.sum(F.col("_sum")[i]).alias(f"_m{i}") for i in range(dim)])
        return per.select(*key_cols, F.array(*[F.col(f"_m{i}") / F.col("_n") for i in range(dim)]).alias(out_col))
    toks = df.select(*key_cols, F.explode_outer(tokens_col).alias("_w"))
    means = toks.join(F.broadcast(vec), "_w", "left").groupBy(*key_cols).agg(
        *[F.avg(F.coalesce(F.col("_v")[i], F.lit(0.0))).alias(f"_m{i}") for i in range(dim)])
    return means.select(*key_cols, F.array(*[F.col(f"_m{i}") for i in range(dim)]).alias(out_col))


def word2vec(input_col: str = "comment", output_col: str = "result", vector_size: int = VECTOR_SIZE,
             min_count: int = MIN_COUNT, seed: int | None = 42, num_partitions: int | None = 1,
             max_iter: int = 1) -> PartWord2Vec:
    """M1 estimator with the reference's settings (seed and parallelism as arguments)."""
    return PartWord2Vec(input_col, output_col, vector_size, min_count, 42 if seed is None else seed, num_partitions or 1, max_iter)


def training_sample(train: DataFrame, max_rows: int, cols: list[str]) -> DataFrame:
    """At most about ``max_rows`` rows, by a stable hash of the row; all rows when there are no more."""
    n = train.count()
    if n <= max_rows:
        return train
    cut = int(2 ** 20 * max_rows / n)
    return train.where(F.pmod(F.xxhash64(*cols), F.lit(2 ** 20)) < cut)


def hinge_sgd(rows: DataFrame, features_col: str, label_col: str, dim: int, iterations: int = SVM_ITERATIONS,
              step: float = SGD_STEP, reg: float = SGD_REG, tolerance: float = SGD_TOLERANCE, parts: int | None = None) -> list[float]:
    """M5 as the reference trains it: full-batch hinge-loss steps, one job each over rows packed once.

    Step t moves by ``step / sqrt(t)`` along the mean gradient and shrinks the weights by the L2 term. Stops
    when the weights move by less than ``tolerance`` relative to their length (from the second step on).
    """
    blocks = packed_blocks(rows, features_col, label_col, parts)
    n, weights = blocks.agg(F.sum("n")).first()[0] or 0, np.zeros(dim)
    for t in range(1, iterations + 1 if n else 0):
        def push(frames, w=weights):
            # A row's push is label sign times features; it counts while its margin is below one.
            for frame in frames:
                out = []
                for block, count, y, x in zip(frame["block"], frame["n"], frame["y"], frame["x"]):
                    signed = np.frombuffer(x, np.float64).reshape(count, dim) * np.frombuffer(y, np.float64)[:, None]
                    out.append((block, signed[signed @ w < 1.0].sum(axis=0).tobytes()))
                yield pd.DataFrame(out, columns=["block", "push"])

        got = sorted(blocks.select("block", "n", "y", "x").mapInPandas(push, "block long, push binary").collect())
        rate = step / t ** 0.5
        after = weights * (1.0 - rate * reg) + rate / n * sum(np.frombuffer(r["push"], np.float64) for r in got)
        moved = float(np.linalg.norm(after - weights))
        weights = after
        if t > 1 and moved < tolerance * max(float(np.linalg.norm(after)), 1.0):
            break
    return weights.tolist()


def stored(rows: DataFrame) -> DataFrame:
    """The rows written once: a fit and its report read them some ten times, and must not clean the texts again each time."""
    return written(rows, "token-rows")


def fit_sentiment(train: DataFrame, input_col: str = "comment", label_col: str = "sentiment",
                  vector_size: int = VECTOR_SIZE, min_count: int = MIN_COUNT, iterations: int = SVM_ITERATIONS,
                  trainer: str = "dual", seed: int | None = 42, num_partitions: int = TRAIN_PARTITIONS,
                  reg_param: float = SGD_REG, max_train_rows: int | None = None,
                  vectors: str = "word2vec", **table_kw) -> SentimentModel:
    """M1 + M3 + M5 (+M7's fit): word vectors on the training rows, then the classifier.

    Word vectors and classifier are learned from every row, unless the caller bounds the classifier's by ``max_train_rows``.
    Words are learned in ``num_partitions`` parts at least, the classifier's rows dealt by hash to as many parts as
    ``ROWS_PER_PART`` asks for and sorted there (few rows are one part, whose ascent reaches the optimum), so the result does not depend on the cluster's cores or on the input's layout. ``vectors="table"`` learns from
    word pairs (``fit_word_table``, which takes ``table_kw``).
    """
    from pyspark import StorageLevel

    if vectors not in ("word2vec", "table"):
        raise ValueError(f"unknown word vectors {vectors!r}")
    if trainer not in ("dual", "sgd", "linearsvc"):
        raise ValueError(f"unknown trainer {trainer!r}")
    rows = train.select(input_col, label_col)
    if max_train_rows is not None:
        rows = training_sample(rows, max_train_rows, [input_col, label_col])
    if vectors == "table":
        w2v_model = fit_word_table(train, input_col, "result", vector_size, min_count, seed=seed or 42, **table_kw)
    else:
        w2v_model = word2vec(input_col, "result", vector_size, min_count, seed, num_partitions).fit(train)
    feats = w2v_model.transform(rows).select(F.col(label_col).cast("double").alias("label"), "result")
    if trainer == "linearsvc":
        feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            svc = LinearSVC(featuresCol="result", labelCol="label", maxIter=iterations, regParam=reg_param,
                            fitIntercept=False, standardization=False, threshold=0.0)
            return SentimentModel(w2v=w2v_model, svc=svc.fit(feats), input_col=input_col)
        finally:
            feats.unpersist()
    points = feats.select("label", vector_to_array("result").alias("x"))
    parts = max(1, math.ceil(rows.count() / ROWS_PER_PART))
    if trainer == "dual":
        weights = hinge_dual(points, "x", "label", vector_size, reg_param, seed=seed or 1, parts=parts).weights
    else:
        weights = hinge_sgd(points, "x", "label", vector_size, iterations, SGD_STEP, reg_param, parts=parts)
    return SentimentModel(w2v=w2v_model, weights=weights, input_col=input_col)


def sentiment_estimator(input_col: str = "comment", vector_size: int = VECTOR_SIZE, min_count: int = MIN_COUNT,
                        iterations: int = SVM_ITERATIONS, seed: int | None = 42,
                        num_partitions: int = TRAIN_PARTITIONS) -> Pipeline:
    """M7 as one Spark ML estimator (Word2Vec -> LinearSVC; needs a double ``label``), saved as a ``PipelineModel``."""
    svc = LinearSVC(featuresCol="result", labelCol="label", maxIter=iterations, regParam=SGD_REG,
                    fitIntercept=False, standardization=False, threshold=0.0)
    w2v = Word2Vec(vectorSize=vector_size, minCount=min_count, inputCol=input_col, outputCol="result", numPartitions=num_partitions)
    return Pipeline(stages=[w2v if seed is None else w2v.setSeed(seed), svc])


def evaluate(model: SentimentModel, df: DataFrame, label_col: str = "sentiment",
             group_cols: list[str] | None = None) -> DataFrame:
    """A4 on a labelled token table: ``(group..., n, wrong, error)``."""
    pred = model.predict(df)
    return error_rate(pred, label_col=label_col, prediction_col="prediction", group_cols=group_cols)


def train_and_report(train_tokens: DataFrame, split_col: str = "split", **fit_kw) -> tuple[SentimentModel, DataFrame]:
    """M7 + K8: fit on the 'train' rows, report error on both splits in one aggregate."""
    rows = stored(train_tokens)
    model = fit_sentiment(rows.where(F.col(split_col) == "train"), **fit_kw)
    report = evaluate(model, rows, group_cols=[split_col])
    return model, report


def sample_eval(model: SentimentModel, samples: DataFrame, text_col: str = "text", label: int = 1) -> DataFrame:
    """M9 (+S4, M4): samples split on single spaces *without* cleaning, all given one label.

    As in the reference the samples are not normalised (T13); the label is an
    argument instead of a hard-coded 1.
    """
    toks = samples.select(F.split(F.col(text_col), " ", -1).alias(model.input_col)).withColumn("label", F.lit(label))
    return evaluate(model, toks, label_col="label")
