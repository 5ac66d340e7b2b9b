"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of hashed n-grams: words and pairs of words, and runs of up to three word
shapes (case, length, last character, equal to the word before). Indicators are scaled by the log ratio of the
n-gram's counts in both classes, rows are scaled to length 1, and a linear hinge-loss model is fitted on them by
dual coordinate descent. A sigmoid fitted on rows that the model has not seen turns margins into scores.

The fit takes a bounded sample of labelled rows (``MAX_FIT_ROWS``, ``MAX_FIT_CELLS``), chosen by hash of the id.
Scoring is one map pass over every whole text with two tables of ``BUCKETS`` numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import (
    Rolling,
    id_key,
    lower_ascii,
    mix64,
    null_id,
    row_keys,
    run_hashes,
    scratch,
    slices,
    text_bytes,
    word_bounds,
)

BUCKETS = 1 << 18
# Documented bounds of the fit: labelled documents, and n-grams of all of them together.
MAX_FIT_ROWS = 20_000
MAX_FIT_CELLS = 12_000_000
SMOOTHING = 1.0        # added to each class's count of an n-gram
COST = 1.0             # bound of a dual variable
EPOCHS = 30
TOLERANCE = 0.01       # largest projected gradient that ends the descent
CALIBRATION_SHARE = 5  # one in so many sampled rows fits the sigmoid instead of the model
HELD_FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.7

_U = np.uint64
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_PUNCT = np.zeros(256, np.uint64)
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _PUNCT[_c] = _c


def _counts(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end] - total[start]


def shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each word's shape: case, length, last character, whether it equals the word before."""
    upper, lower = _counts(_UPPER[data], start, end), _counts(_LOWER[data], start, end)
    size = end - start
    case = np.where(upper + lower == 0, 0, np.where(upper == 0, 1, np.where((upper == 1) & _UPPER[data[start]] & (size > 1), 2,
                                                                            np.where(lower == 0, 3, 4))))
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    begins = first[:-1]
    same[begins[begins < len(words)]] = False
    return (case.astype(np.uint64) + _U(5) * np.minimum(size // 4, 4).astype(np.uint64) + _U(25) * same.astype(np.uint64)
            + _U(50) * _PUNCT[data[end - 1]])


def grams(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of every text's distinct n-grams, ordered by text and bucket."""
    low = lower_ascii(data)
    start, end, first = word_bounds(low, off)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = Rolling(low).of(start, end)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    shape = mix64(shapes(data, start, end, words, first) + _U(1 << 40))
    keys = []
    for kind, (unit, most) in enumerate(((words, 2), (shape, 3))):
        for width in range(1, most + 1):
            h, place = run_hashes(unit, first, width)
            h = mix64(h + _U((kind * 8 + width) << 50))
            keys.append(text[place].astype(np.uint64) * _U(buckets) + h % _U(buckets))
    key = np.unique(np.concatenate(keys))
    return (key // _U(buckets)).astype(np.int64), (key % _U(buckets)).astype(np.int64)


@dataclass
class Classifier:
    """``margin = sum(weight[b]) / sqrt(sum(square[b])) + bias`` over a text's n-grams; a sigmoid makes the score."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, text: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        top = np.bincount(text, self.weight[bucket], minlength=n)
        size = np.bincount(text, self.square[bucket], minlength=n)
        margin = top / np.sqrt(np.maximum(size, 1e-12)) + self.bias
        return _sigmoid(self.slope * margin + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0)))


def log_count_ratio(good: np.ndarray, bad: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of the classes' smoothed, normalised counts of each n-gram; 0 where neither has it."""
    p, q = good + smoothing, bad + smoothing
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(good + bad > 0, ratio, 0.0)


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS,
                 tolerance: float = TOLERANCE, seed: int = 3) -> tuple[np.ndarray, float, np.ndarray]:
    """Hinge loss with an L2 term: weights on the scaled indicators, bias (a feature of value 1), dual variables.

    Every step solves one row's dual variable exactly within [0, cost]; rows are visited in a new random order
    each epoch until no projected gradient passes ``tolerance``.
    """
    rng = np.random.default_rng(seed)
    scale = [ratio[r] / max(math.sqrt(float(ratio[r] @ ratio[r])), 1e-6) for r in rows]
    norm = [float(s @ s) + 1.0 for s in scale]
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r, s = rows[i], scale[i]
            slope = y[i] * (float(w[r] @ s) + bias) - 1.0
            a = alpha[i]
            push = min(slope, 0.0) if a <= 0.0 else max(slope, 0.0) if a >= cost else slope
            if push == 0.0:
                continue
            worst = max(worst, abs(push))
            alpha[i] = min(max(a - slope / norm[i], 0.0), cost)
            step = (alpha[i] - a) * y[i]
            w[r] += step * s
            bias += step
        if worst <= tolerance:
            break
    return w, bias, alpha


def fit_sigmoid(margin: np.ndarray, label: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the sigmoid, by Newton steps with smoothed targets and a small ridge."""
    good, bad = label.sum(), (~label).sum()
    target = np.where(label, (good + 1.0) / (good + 2.0), 1.0 / (bad + 2.0))
    ab = np.array([1.0, 0.0])
    x = np.column_stack([margin, np.ones(len(margin))])

    def loss(v):
        z = x @ v
        return float((np.logaddexp(0.0, z) - target * z).sum()) + 1e-3 * float(v @ v)

    for _ in range(steps):
        p = _sigmoid(x @ ab)
        gradient = x.T @ (p - target) + 2e-3 * ab
        hessian = (x * (p * (1.0 - p))[:, None]).T @ x + 2e-3 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(ab - size * step) > loss(ab):
            size /= 2.0
        ab = ab - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


def fit(rows: list[np.ndarray], good: np.ndarray, check: np.ndarray, buckets: int = BUCKETS, **args) -> Classifier:
    """A classifier from rows of n-grams; rows with ``check`` only fit the sigmoid. Without both classes among
    the others every score is the smoothed share of good rows."""
    flat = Classifier(np.zeros(buckets), np.zeros(buckets), 0.0, 0.0, math.log((good.sum() + 1.0) / ((~good).sum() + 1.0)))
    at = np.flatnonzero(~check)
    if not len(at) or good[at].all() or not good[at].any():
        return flat
    used = [rows[i] for i in at]
    cells = [np.bincount(np.concatenate([r for r, g in zip(used, good[at]) if g == side] or [np.zeros(0, np.int64)]), minlength=buckets)
             for side in (True, False)]
    ratio = log_count_ratio(*[c.astype(np.float64) for c in cells])
    w, bias, _ = dual_descent(used, np.where(good[at], 1.0, -1.0), ratio, **args)
    model = Classifier(w * ratio, ratio * ratio, bias, 1.0, 0.0)
    tested = np.flatnonzero(check)
    if len(tested) and good[tested].any() and not good[tested].all():
        text = np.repeat(np.arange(len(tested)), [len(rows[i]) for i in tested])
        bucket = np.concatenate([rows[i] for i in tested])
        top = np.bincount(text, model.weight[bucket], minlength=len(tested))
        size = np.bincount(text, model.square[bucket], minlength=len(tested))
        model.slope, model.shift = fit_sigmoid(top / np.sqrt(np.maximum(size, 1e-12)) + bias, good[tested])
        model.slope = max(model.slope, 0.0)
    return model


# ---------------------------------------------------------------------------
# tables

def is_held_out(id_col: str) -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 4 (a null id: not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_FOLDS == HELD_FOLD, F.lit(False))


def chosen_labels(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """``(_l, _y)``: labelled ids to learn from, ``max_rows`` at most, by hash of the id; a third of the rows' ids
    may be one id, which counts once, with its smallest label.

    The cut is read off a histogram of 4,096 hash values, so no task and not the driver sees the ids in order.
    """
    hashed = F.shiftrightunsigned(F.xxhash64("_l", F.lit(12)), 52)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~is_held_out(id_col))
             .select(F.col(id_col).cast("long").alias("_l"), F.col(label_col).cast("int").alias("_y"))
             .groupBy("_l").agg(F.min("_y").alias("_y")).withColumn("_at", hashed))
    known = scratch(known, "nbsvm-labels")
    cut, n = -1, 0
    for at, m in sorted(map(tuple, known.groupBy("_at").count().collect())):   # 4,096 rows at most
        if n + m > max_rows:
            break
        cut, n = at, n + m
    return known.where(F.col("_at") <= cut).drop("_at")


def _gram_rows(batches):
    for batch in batches:
        for part in slices(batch):
            data, off = text_bytes(part.column("_t"))
            text, bucket = grams(data, off)
            cut = np.searchsorted(text, np.arange(part.num_rows + 1))
            cells = [bucket[a:b].astype("<u4").tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.record_batch([part.column("_l"), part.column("_y"), pa.array(np.diff(cut)), pa.array(cells, pa.binary())],
                                  ["_l", "_y", "n", "cells"])


def fit_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_fit_rows: int = MAX_FIT_ROWS, max_fit_cells: int = MAX_FIT_CELLS,
                   **args) -> Classifier:
    """Fit on at most ``max_fit_rows`` labelled documents outside the held-out fold and ``max_fit_cells`` n-grams.

    A labelled id with several texts is learnt by one of them (the least hash). What reaches the driver is
    bounded by both arguments, whatever the corpus.
    """
    chosen = chosen_labels(labels, id_col, label_col, max_fit_rows)
    # At most max_fit_rows ids of 12 bytes: a proven bound for the broadcast.
    some = row_keys(docs.where(F.col(id_col).isNotNull()), id_col, text_col).join(F.broadcast(chosen), F.col("_d") == F.col("_l"))
    once = some.groupBy("_l", "_y").agg(F.min_by("_t", "_h").alias("_t"))
    table = scratch(once.mapInArrow(_gram_rows, "_l long, _y int, n long, cells binary"), "nbsvm-fit")
    order = F.xxhash64("_l", F.lit(13))
    sizes = table.select(order.alias("at"), "n").toPandas().sort_values("at", kind="stable")
    held = int((sizes["n"].cumsum() <= max_fit_cells).sum())
    if held < len(sizes):
        table = table.where(order < F.lit(int(sizes["at"].iloc[held])))
    rows = table.select("_l", "_y", "cells", (F.pmod(F.xxhash64("_l", F.lit(14)), F.lit(CALIBRATION_SHARE)) == 0).alias("check")).toPandas()
    rows = rows.sort_values("_l", kind="stable")
    return fit([np.frombuffer(c, "<u4").astype(np.int64) for c in rows["cells"]], rows["_y"].to_numpy(np.int64) == 1,
               rows["check"].to_numpy(bool), **args)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   carry: Sequence[str] = (), model: Classifier | None = None, threshold: float = THRESHOLD,
                   **fit_args) -> DataFrame:
    """``(id_col, carry..., held_out, score, predicted)``: one row for each row of ``docs``.

    ``score`` in (0, 1) is higher where the label 1 is likelier; ``predicted`` is 1 from ``threshold`` on. Rows whose
    crc32 of the id leaves 2 modulo 4 are never learnt from. Only texts are features.

    Defined cases: a null or empty text has no n-grams and gets the score of the bias; repeated rows get the
    same score; a very long text is one slice; null labels and labels of null ids are not used, an id with
    two labels counts with the smaller; without both classes every score is the smoothed share of label 1 (0.5
    without labels); an empty table gives no rows; other columns are not read.
    """
    model = model or fit_classifier(docs, labels, id_col, text_col, **fit_args)
    rows = row_keys(docs, id_col, text_col, carry)
    kept = ["_d", *[f"_c{i}" for i in range(len(carry))]]

    def judge(batches):
        for batch in batches:
            for part in slices(batch):
                text, bucket = grams(*text_bytes(part.column("_t")))
                yield pa.record_batch([*[part.column(c) for c in kept], pa.array(model.scores(text, bucket, part.num_rows))],
                                      [*kept, "score"])

    # The model travels with the function: two tables of BUCKETS numbers, whatever the corpus.
    schema = rows.select(*kept).schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", score double"
    out = rows.mapInArrow(judge, schema).withColumn("_id", null_id())
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                      is_held_out("_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
