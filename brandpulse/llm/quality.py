"""Quality rules: statistics of each whole text, two fixed rules, and an isolation forest over the
statistics whose threshold is calibrated on labelled rows.

Statistics, rules and path lengths cover every row, one map pass without a shuffle. The forest and its threshold
come from all labelled rows: every tree draws its subsample from all of them, and the threshold weighs every one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import Rolling, id_key, mix64, null_id, row_keys, run_hashes, scratch, slices, text_bytes, word_bounds

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
# Thresholds are multiples of one part in so many: at most that many counts come to the driver.
BINS = 65_536
TREES = 100
SUBSAMPLE = 256
# A good row that the threshold gives up costs as much as so many bad rows that it lets through.
GOOD_COST = 10.0
# Rows labelled bad enter the trees' draws at this share of the good ones, so that anomalies stay few and far.
BAD_SHARE = 0.05

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_bytes", "n_upper", "n_letters")

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LETTER = _IS_UPPER.copy()
_IS_LETTER[97:123] = True
_IS_LETTER[128:] = True


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    places = np.searchsorted(np.flatnonzero(flags), off)
    return places[1:] - places[:-1]


def _text_of(places: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, places, side="right") - 1


def text_statistics(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every text of a byte array (see ``quality_statistics`` for their meaning)."""
    n = len(off) - 1
    start, end, first = word_bounds(data, off)
    hashes = Rolling(data)
    out = {"n_words": np.diff(first)}
    in_word = (data & 0xC0) != 0x80                       # one byte of each code point
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=chars[1:])
    lengths = np.zeros(len(start) + 1, np.int64)
    np.cumsum(chars[end] - chars[start], out=lengths[1:])
    out["word_chars"] = lengths[first[1:]] - lengths[first[:-1]]
    out["n_symbols"] = _per_text(_IS_SYMBOL[data], off)

    # Lines of every text; a line counts as repeated if it has a word and an equal line stands before it.
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    line_text = np.repeat(np.arange(n), 1 + _per_text(data == 10, off))
    line_end = np.append(line_start[1:], len(data))
    line_end = np.minimum(np.where(np.append(line_text[1:], n) == line_text, line_end - 1, off[line_text + 1]),
                          off[line_text + 1])
    words_in = np.searchsorted(start, line_end) - np.searchsorted(start, line_start)
    full = np.flatnonzero(words_in > 0)
    key = hashes.of(line_start[full], line_end[full]) ^ _salt(line_text[full])
    _, at = np.unique(key, return_index=True)
    again = np.ones(len(full), bool)
    again[at] = False
    out["n_dup_lines"] = np.bincount(line_text[full[again]], minlength=n)

    # Words covered by a 3-word window that occurs twice or more in its text.
    runs, place = run_hashes(hashes.of(start, end), first, 3)
    covered = np.zeros(len(start) + 3, bool)
    if len(runs):
        runs = runs ^ _salt(_text_of(place, first))
        order = np.argsort(runs, kind="stable")
        same = runs[order][1:] == runs[order][:-1]
        twice = np.zeros(len(runs), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            covered[place[twice] + j] = True
    out["n_repeat_words"] = _per_text(covered[:len(start)], first)

    out["n_bytes"] = np.diff(off)
    out["n_upper"] = _per_text(_IS_UPPER[data], off)
    out["n_letters"] = _per_text(_IS_LETTER[data] & in_word, off)
    return out


def _salt(text: np.ndarray) -> np.ndarray:
    return (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics of one row each, as ratios that do not grow with the text. (Repeated lines are left out: good
    texts share lines too, and with them the forest tells labelled bad rows apart worse.)"""
    f = {k: np.asarray(v, np.float64) for k, v in c.items()}
    words, letters, size = (np.maximum(f[k], 1.0) for k in ("n_words", "n_letters", "n_bytes"))
    return np.column_stack([
        f["word_chars"] / words, f["n_symbols"] / words, f["n_symbols"] / size, f["n_repeat_words"] / words,
        f["n_upper"] / letters,
    ])


@dataclass
class Forest:
    """Isolation trees as arrays (tree, node): split feature (-1: leaf), value, children, path length of leaves."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    length: np.ndarray
    norm: float
    threshold: float = math.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 ** -(mean path length / expected path length)."""
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[row, np.maximum(f, 0)] >= self.value[t, node]
                node = np.where(inner, self.child[t, node] + right, node)
            total += self.length[t, node]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.norm)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search in a tree of n points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def fit_forest(drawn: list[np.ndarray], seed: int = 11) -> Forest:
    """A tree for each subsample drawn: random splits down to ceil(log2(subsample)) levels."""
    rng = np.random.default_rng(seed)
    m = max((len(x) for x in drawn), default=0)
    depth = max(1, math.ceil(math.log2(max(m, 2))))
    size = 2 ** (depth + 1)
    trees = len(drawn)
    feature = np.full((trees, size), -1, np.int64)
    value, length = np.zeros((trees, size)), np.zeros((trees, size))
    child = np.zeros((trees, size), np.int64)
    for t, pick in enumerate(drawn):
        todo, free = [(0, pick, 0)], 1
        while todo:
            node, rows, level = todo.pop()
            low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(pick.shape[1]),) * 2
            can = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or not len(can):
                length[t, node] = level + _expected(len(rows))
                continue
            f = int(rng.choice(can))
            cut = float(rng.uniform(low[f], high[f]))
            right = rows[:, f] >= cut
            feature[t, node], value[t, node], child[t, node] = f, cut, free
            todo += [(free, rows[~right], level + 1), (free + 1, rows[right], level + 1)]
            free += 2
    return Forest(feature, value, child, length, max(_expected(m), 1.0))


def score_bins(scores: np.ndarray) -> np.ndarray:
    """The bin k of each score: ``k / BINS < score <= (k + 1) / BINS``."""
    return np.ceil(scores * BINS).astype(np.int64) - 1


def threshold_of(bins: np.ndarray, good: np.ndarray, bad: np.ndarray, good_cost: float = GOOD_COST) -> float:
    """The threshold with the least cost over the labelled rows' scores, given as counts of good and bad rows by bin:
    bad rows at or below it count 1, good rows above it ``good_cost``. Of equal ones the highest; without good rows
    nothing is rejected."""
    if not good.sum():
        return math.inf
    order = np.argsort(bins)
    bins, good, bad = bins[order], good[order], bad[order]
    cost = good_cost * (good.sum() - np.cumsum(good)) + np.cumsum(bad)
    at = len(cost) - 1 - int(np.argmin(cost[::-1]))
    # Halfway to the next bin with rows: rows unlike any labelled one are judged by the nearer side.
    return float((bins[at] + 1) / BINS if at + 1 == len(bins) else (bins[at] + 1 + bins[at + 1]) / 2 / BINS)


_ALL = (*COUNTS, *_MORE)


def _statistics(batches):
    for batch in batches:
        for part in slices(batch):
            c = text_statistics(*text_bytes(part.column("_t")))
            yield pa.record_batch([*[part.column(i) for i in range(part.num_columns)],
                                   *[pa.array(c[k], pa.int64()) for k in _ALL]],
                                  [*part.schema.names, *_ALL])


def quality_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       carry: Sequence[str] = ()) -> DataFrame:
    """``(_d, _h, _t, carried columns)`` and the counts of each whole text (null: no words).

    n_words; word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``; n_dup_lines: lines
    with a word that equal an earlier line; n_repeat_words: words in 3-word windows found twice or more.
    """
    rows = row_keys(docs, id_col, text_col, carry)
    schema = rows.schema.simpleString()[len("struct<"):-1].replace(":", " ") + "".join(f", {k} long" for k in _ALL)
    return rows.mapInArrow(_statistics, schema)


def _counts(batches):
    for batch in _statistics(batches):
        yield batch.select(["_d", "_h", *_ALL])


def labelled_statistics(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        label_col: str = "quality") -> DataFrame:
    """``(_d, _h, _y, counts)`` of every labelled row that passes the base rules (null labels and ids aside), written once.

    One label (the least) and one text (the least hash) an id, however often the id is repeated. Counts meet the labels, texts never do.
    """
    label = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .select(id_key(id_col).alias("_d"), F.col(label_col).cast("int").alias("_y"))
             .groupBy("_d").agg(F.min("_y").alias("_y")))
    counts = row_keys(docs, id_col, text_col).mapInArrow(_counts, "_d long, _h long" + "".join(f", {k} long" for k in _ALL))
    once = counts.groupBy("_d").agg(F.min_by(F.struct("_h", *_ALL), "_h").alias("_s")).select("_d", "_s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scratch(once.join(label, "_d").where(~failed).select("_d", "_h", "_y", *_ALL), "quality-labelled")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 11) -> Forest:
    """Fit and calibrate on all labelled rows that pass the base rules.

    A tree draws the ``subsample`` rows with the least hash of tree and row among all good rows and a few bad ones
    (``BAD_SHARE``); the threshold weighs every row. The driver gets about twice the draws and one count for each bin of
    scores. Without labelled rows nothing is rejected.
    """
    rows = labelled_statistics(docs, labels, id_col, text_col, label_col)
    is_good = F.col("_y") == 1
    n_good, n_bad = rows.agg(F.count_if(is_good), F.count_if(~is_good)).first()
    share = min(1.0, BAD_SHARE * n_good / max(n_bad, 1))
    # About twice the rows a tree takes have a hash below this; where there are few rows, all have.
    below = min(1.0, 2.0 * subsample / max(n_good + share * n_bad, 1.0))

    def hashed(batch, salt: int) -> np.ndarray:
        key = batch.column("_h").to_numpy().view(np.uint64) ^ mix64(batch.column("_d").to_numpy().view(np.uint64))
        return mix64(key ^ mix64(np.array([seed * 1_000_003 + salt], np.uint64))) / 2.0 ** 64

    def draw(batches):
        for batch in batches:
            x = features({k: batch.column(k).to_numpy() for k in _ALL})
            inside = (batch.column("_y").to_numpy() == 1) | (hashed(batch, 0) < share)
            for t in range(trees):
                key = hashed(batch, t + 1)
                at = np.flatnonzero(inside & (key <= below))
                if len(at):
                    yield pa.record_batch([pa.array(np.full(len(at), t)), pa.array(key[at]), pa.array(list(x[at]), pa.list_(pa.float64()))],
                                          ["tree", "key", "x"])

    drawn = rows.mapInArrow(draw, "tree long, key double, x array<double>").toPandas().sort_values(["tree", "key"])
    width = features({k: np.zeros(1) for k in _ALL}).shape[1]
    picks = {t: np.array(g["x"].tolist()[:subsample]) for t, g in drawn.groupby("tree")}
    forest = fit_forest([picks.get(t, np.zeros((0, width))) for t in range(trees)], seed)

    def judged(batches):
        for batch in batches:
            bins = score_bins(forest.scores(features({k: batch.column(k).to_numpy() for k in _ALL})))
            yield pa.record_batch([pa.array(bins), batch.column("_y")], ["bin", "_y"])

    by_bin = (rows.mapInArrow(judged, "bin long, _y int").groupBy("bin")
              .agg(F.count_if(is_good).alias("good"), F.count_if(~is_good).alias("bad")).orderBy("bin").toPandas())
    forest.threshold = threshold_of(*(by_bin[c].to_numpy(np.int64) for c in ("bin", "good", "bad")))
    return forest


def base_failed(c: dict[str, np.ndarray], min_words: int = MIN_WORDS) -> np.ndarray:
    return (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  carry: Sequence[str] = (), forest: Forest | None = None, **fit_args) -> DataFrame:
    """Statistics and verdict of every row: ``(id_col, text_col, carry..., counts, base_failed, anomaly, kept)``.

    ``kept``: the base rules hold and the anomaly score does not pass the calibrated threshold.

    Defined cases: a null or empty text has no words and fails the base rule; repeated rows get the same
    verdict; very long texts are one slice each; with no labelled rows only the base rules reject; an empty
    table gives no rows; other columns are not read.
    """
    forest = forest or fit_quality(docs, labels, id_col, text_col, **fit_args)
    stats = quality_statistics(docs, id_col, text_col, carry)
    held = stats.schema.names

    def judge(batches):
        for batch in batches:
            c = {k: batch.column(k).to_numpy() for k in _ALL}
            score, failed = forest.scores(features(c)), base_failed(c)
            yield pa.record_batch([*[batch.column(i) for i in range(batch.num_columns)], pa.array(failed),
                                   pa.array(score), pa.array(~failed & ~(score > forest.threshold))],
                                  [*held, "base_failed", "anomaly", "kept"])

    schema = stats.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    out = stats.mapInArrow(judge, schema + ", base_failed boolean, anomaly double, kept boolean")
    return out.select(null_id().alias(id_col), F.col("_t").alias(text_col),
                      *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                      *COUNTS, "base_failed", "anomaly", "kept")
