"""Word vectors without a vocabulary on the driver: skip-gram with negative sampling over partitioned tables.

Spark ML's ``Word2Vec`` holds the vocabulary and both weight tables on the driver. Here words are dealt to buckets by
hash, and a bucket's vectors are one row of a table. The pairs (word, context word) are counted once; a pair of buckets is
a block, and blocks that share neither bucket form a stratum. A step is one Spark job over one stratum: every task gets
the word vectors of one bucket, the context vectors of another and the block's pairs, learns from them in numpy, and writes
the vectors back. No two tasks of a step touch one vector, so nothing is averaged and no gradient is shuffled; after
as many steps as there are buckets (an epoch) every pair has been seen once. Every step's vectors are written to the shared
folder, so a lost executor costs one task and a stopped fit goes on where it stood (``path``).

The objective is that of skip-gram: sum over pairs of ``n * log s(u.v)`` plus, for each word, ``negatives * n(word)`` times the
mean of ``log s(-u.v)`` over context words drawn by count ** 0.75. ``n`` is the expected number of times the pair is
seen when the window shrinks at random, times the window: distance d counts ``window + 1 - d``. Noise is drawn by a seeded
generator inside a block from the block's own context bucket, weighted with that bucket's share of all noise, so over an
epoch its expectation is the whole sum. Steps are scaled by AdaGrad, one sum of squares for each vector.

The driver holds the number of words, of pairs and the noise's total. A task holds two buckets (``words_per_bucket`` words
each, 4 * dim bytes a word) and a block's pairs (12 bytes each, ``pairs_per_block`` in the mean); the number of buckets
follows from both bounds. A frequent word adds at most one pair for each word of the other bucket to a block.

Token lists are cut after ``sentence`` words, as Spark ML does. Null lists and null words give nothing, an empty string is a word,
words seen fewer than ``min_count`` times keep their place in the window but have no vector. No words: an empty table.
The result depends on the rows (not on their order or partitions), the seed and the settings.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brandpulse.functions.text import array_input
from brandpulse.llm.common import mix64
from brandpulse.session import scratch_path
from brandpulse.sinks.keyed import Store

# Spark ML's settings (fixed values): window and longest sentence.
WINDOW = 5
SENTENCE = 1000
NEGATIVES = 5
NOISE_POWER = 0.75
EPOCHS = 5
RATE = 0.3
BATCH = 4096
MIN_BUCKETS = 8
WORDS_PER_BUCKET = 65_536
PAIRS_PER_BLOCK = 4_000_000
SLICE_PAIRS = 262_144
# Words whose pairs are counted together in a task, and pairs of one batch of its output.
CHUNK_WORDS = 2_000_000
PAIR_ROWS = 65_536
# Parts of the pairs for each partition of a shuffle.
PARTS_PER_TASK = 4

_PARAMS = "kind int, bucket int, size int, data binary"
_SLICES = "stratum int, bucket int, slice int, size int, data binary"
_WORD, _CONTEXT, _PAIRS = 0, 1, 2


def sentences(df: DataFrame, tokens_col: str, length: int = SENTENCE) -> DataFrame:
    """``(_s)``: the token lists in runs of at most ``length`` words, nulls left out."""
    # The generator stands between, so that no check of the tokens is pushed below it and run again.
    words = df.select(F.explode(F.array(F.array_compact(F.col(tokens_col)))).alias("_t"))
    starts = F.when(F.size("_t") > 0, F.sequence(F.lit(0), F.floor((F.size("_t") - 1) / length).cast("int")))
    return words.select(F.explode(F.transform(starts, lambda k: F.slice(F.col("_t"), k * length + 1, length))).alias("_s"))


def word_counts(df: DataFrame, tokens_col: str, min_count: int = 0) -> DataFrame:
    """``(word, n)`` for every word seen at least ``min_count`` times."""
    counts = df.select(F.explode(F.array_compact(array_input(tokens_col))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count) if min_count > 1 else counts


def _ranked(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of words by their order as bytes, and the different words in that order."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy(zero_copy_only=False)], coded.dictionary.take(pa.array(order))


def _pair_rows(names: pa.Array, a: np.ndarray, b: np.ndarray, n: np.ndarray):
    for lo in range(0, len(a), PAIR_ROWS):
        sides = [names.take(pa.array(x[lo:lo + PAIR_ROWS])).cast(pa.binary()).cast(pa.string()) for x in (a, b)]
        yield pa.RecordBatch.from_arrays([*sides, pa.array(n[lo:lo + PAIR_ROWS], pa.int64())], ["a", "b", "n"])


def _chunk_pairs(lists: list[pa.Array], window: int, parts: int | None):
    """Pairs of some runs of words with their summed weights, each pair once: ``(a, b, n)`` with ``a <= b`` by bytes.

    With ``parts`` the pairs of one part (a hash of the two words) are a packed row: its words
    once, in the order of their bytes, and a pair as three numbers, by zstd.
    """
    words = pa.chunked_array([x.flatten() for x in lists]).cast(pa.large_binary()).combine_chunks()
    sizes = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists])
    ids, names = _ranked(words)
    run, base = np.repeat(np.arange(len(sizes)), sizes), max(len(names), 1)
    keys = []
    for d in range(1, window + 1):
        x, y = ids[:-d][run[:-d] == run[d:]], ids[d:][run[:-d] == run[d:]]
        keys.append((np.minimum(x, y) * base + np.maximum(x, y)) * window + (window - d))
    keys = np.concatenate(keys)
    keys.sort()
    weight = keys % window + 1
    keys //= window
    if not len(keys):
        return
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    n, pairs = np.add.reduceat(weight, starts), keys[starts]
    a, b = pairs // base, pairs % base
    if parts is None:
        yield from _pair_rows(names, a, b, n)
        return
    key = pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False)
    part = (mix64(key[a] ^ mix64(key[b])) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    a, b, n, part = a[order], b[order], n[order], part[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    for lo, hi in zip(edges[:-1], edges[1:]):
        own, at = np.unique(np.concatenate([a[lo:hi], b[lo:hi]]), return_inverse=True)
        at = at.astype(np.int32)
        row = pa.record_batch([pa.array([x], pa.list_(x.type)) for x in (
            names.take(pa.array(own)), pa.array(at[:hi - lo]), pa.array(at[hi - lo:]), pa.array(n[lo:hi], pa.int64()))], ["words", "a", "b", "n"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(row)
        yield pa.record_batch([pa.array([part[lo]]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["part", "data"])


def _merged(batches):
    """The packed rows of each part to ``(a, b, n)``, each pair once."""
    for batch in batches:
        for packed in batch.column(0):
            rows = [next(iter(pa.ipc.open_stream(x.as_buffer()))) for x in packed.values]
            words = [r.column("words").flatten() for r in rows]
            ids, names = _ranked(pa.concat_arrays(words))
            first, base = np.cumsum([0, *(len(w) for w in words)]), max(len(names), 1)
            a, b, n = ([r.column(c).flatten().to_numpy() for r in rows] for c in "abn")
            a, b = (np.concatenate([ids[lo + x] for lo, x in zip(first, side)]) for side in (a, b))
            keys, n = a * base + b, np.concatenate(n)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            yield from _pair_rows(names, keys[starts] // base, keys[starts] % base, np.add.reduceat(n[order], starts))


def _met(window: int, parts: int | None = None):
    """Rows of runs of words to their pairs, counted over ``CHUNK_WORDS`` words at a time (see ``_chunk_pairs``)."""
    def run(batches):
        held, words = [], 0
        for batch in batches:
            column, lo = batch.column(0), 0
            ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
            while lo < len(ends):
                done = ends[lo - 1] if lo else 0
                hi = max(int(np.searchsorted(ends, done + CHUNK_WORDS - words, "right")), lo + 1)
                held.append(column.slice(lo, hi - lo))
                words, lo = words + int(ends[hi - 1] - done), hi
                if words >= CHUNK_WORDS or lo < len(ends):
                    yield from _chunk_pairs(held, window, parts)
                    held, words = [], 0
        if held:
            yield from _chunk_pairs(held, window, parts)

    return run


def word_pairs(df: DataFrame, tokens_col: str, window: int = WINDOW, length: int = SENTENCE) -> DataFrame:
    """``(a, b, n)`` with ``a <= b``: how often two words meet, distance d counting ``window + 1 - d``.

    Counted in numpy inside every task first, so the shuffle has a pair once for each ``CHUNK_WORDS`` words: a pair that is
    everywhere is a few entries a task. What it moves are packed rows, in which a word stands once and a pair is three
    numbers. There are ``PARTS_PER_TASK`` parts for each partition of a shuffle, and a task merges one after the other.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = sentences(df, tokens_col, length).mapInArrow(_met(window, tasks * PARTS_PER_TASK), "part long, data binary")
    packed = met.repartition(tasks, "part").groupBy("part").agg(F.collect_list("data").alias("data"))
    return packed.select("data").mapInArrow(_merged, "a string, b string, n long")


def directed(pairs: DataFrame, a: list[str], b: list[str]) -> DataFrame:
    """Both directions of symmetric pairs; ``a`` and ``b`` name the columns of either end, which become ``w_*`` and ``c_*``."""
    def way(x, y, n):
        return F.struct(*[F.col(p).alias(f"w_{k}") for k, p in enumerate(x)],
                        *[F.col(q).alias(f"c_{k}") for k, q in enumerate(y)], n.alias("n"))

    same = F.lit(True)
    for p, q in zip(a, b):
        same = same & (F.col(p) == F.col(q))
    ways = F.when(same, F.array(way(a, b, 2 * F.col("n")))).otherwise(F.array(way(a, b, F.col("n")), way(b, a, F.col("n"))))
    return pairs.select(F.explode(ways).alias("_p")).select("_p.*")


def context_counts(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(word, n, contexts, weight)``: how many different words stand near a word, and their pairs' summed weight."""
    per = directed(pairs, ["a"], ["b"]).groupBy(F.col("w_0").alias("word")).agg(
        F.count("*").alias("contexts"), F.sum("n").alias("weight"))
    zero = F.lit(0).cast("long")
    return words.join(per, "word", "left").select(
        "word", "n", F.coalesce("contexts", zero).alias("contexts"), F.coalesce("weight", zero).alias("weight"))


def _pack(batches):
    """Sorted pairs as slices of one block each: word numbers, context numbers, weights."""
    names = ["stratum", "bucket", "slice", "size", "data"]
    types = pa.schema([("stratum", pa.int32()), ("bucket", pa.int32()), ("slice", pa.int32()), ("size", pa.int32()), ("data", pa.binary())])
    block, held, number = None, [], 0

    def take(n):
        nonlocal held, number
        i, j, w = (np.concatenate([h[k] for h in held]) for k in range(3))
        data = i[:n].astype("<i4").tobytes() + j[:n].astype("<i4").tobytes() + w[:n].astype("<f4").tobytes()
        row = dict(zip(names, ([block[0]], [block[1]], [number], [min(n, len(i))], [data])))
        held, number = ([(i[n:], j[n:], w[n:])] if len(i) > n else []), number + 1
        return pa.RecordBatch.from_pydict(row, schema=types)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("stratum", "bucket", "i", "j", "n")}
        edge = np.flatnonzero((np.diff(cols["stratum"]) != 0) | (np.diff(cols["bucket"]) != 0)) + 1
        for lo, hi in zip([0, *edge], [*edge, batch.num_rows]):
            here = (int(cols["stratum"][lo]), int(cols["bucket"][lo]))
            if here != block:
                if held:
                    yield take(SLICE_PAIRS)
                block, held, number = here, [], 0
            held.append((cols["i"][lo:hi], cols["j"][lo:hi], cols["n"][lo:hi]))
            while sum(len(h[0]) for h in held) > SLICE_PAIRS:
                yield take(SLICE_PAIRS)
    if held:
        yield take(SLICE_PAIRS)


def _move(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """One AdaGrad step of the rows named, gradients of one row summed first."""
    order = np.argsort(rows, kind="stable")
    at, starts = np.unique(rows[order], return_index=True)
    total = np.add.reduceat(grads[order], starts, axis=0)
    squares[at] += np.einsum("ij,ij->i", total, total) / table.shape[1]
    table[at] -= (rate / np.sqrt(squares[at] + 1e-12))[:, None] * total


def learn_block(u, u_sq, u_n, v, v_sq, noise, i, j, w, mass: float, negatives: int, rate: float, seed) -> None:
    """Learn one block in place. ``mass`` is the weight that all noise pairs of the block carry together."""
    rng = np.random.default_rng(seed)
    words, contexts = np.cumsum(u_n, dtype=np.float64), np.cumsum(noise, dtype=np.float64)
    draws = max(negatives * len(i), len(u)) if negatives and len(u) and len(v) and words[-1] > 0 else 0
    ni = np.searchsorted(words, rng.random(draws) * words[-1], "right") if draws else np.zeros(0, np.int64)
    nj = np.searchsorted(contexts, rng.random(draws) * contexts[-1], "right") if draws else np.zeros(0, np.int64)
    i = np.concatenate([i, np.minimum(ni, len(u) - 1)]).astype(np.int64)
    j = np.concatenate([j, np.minimum(nj, len(v) - 1)]).astype(np.int64)
    target = np.concatenate([np.ones(len(w), np.float32), np.zeros(draws, np.float32)])
    w = np.concatenate([w, np.full(draws, mass / max(draws, 1))]).astype(np.float32)
    order = rng.permutation(len(i))
    for a in range(0, len(order), BATCH):
        at = order[a:a + BATCH]
        x, y = u[i[at]], v[j[at]]
        near = 1.0 / (1.0 + np.exp(-np.clip(np.einsum("ij,ij->i", x, y), -30.0, 30.0)))
        push = (w[at] * (near - target[at]))[:, None].astype(np.float32)
        _move(u, u_sq, i[at], push * y, rate)
        _move(v, v_sq, j[at], push * x, rate)


def _bucket_of(size: int, data: bytes, dim: int):
    """A parameter row's vectors, sums of squares and frequencies."""
    flat = np.frombuffer(data, "<f4").copy()
    return flat[:size * dim].reshape(size, dim), flat[size * dim:size * (dim + 1)], flat[size * (dim + 1):]


@dataclass
class WordTable:
    """Fitted word vectors as a table ``(word, vector array<float>)`` in ``path``; stands where a ``Word2VecModel`` does."""

    spark: SparkSession
    path: str
    dim: int
    input_col: str = "comment"
    features_col: str = "result"

    def getVectors(self) -> DataFrame:
        return self.spark.read.schema("word string, vector array<float>").parquet(f"{self.path}/vectors")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean vector of each token list (unknown words count as 0, an empty or null list is all zeros)."""
        from brandpulse.operators.token_parts import list_key, list_sums

        keyed = df.withColumns(list_key(self.input_col))
        sums = list_sums(keyed, self.input_col, self.getVectors().select(F.col("word").alias("_w"), F.col("vector").alias("_v")), self.dim)
        mean = F.transform("_sum", lambda x: x / F.greatest("_n", F.lit(1)))
        return keyed.join(sums.select("_k1", "_k2", array_to_vector(mean).alias(self.features_col)), ["_k1", "_k2"], "left").drop("_k1", "_k2")

    def nearest(self, word: str, k: int = 10) -> DataFrame:
        """``(word, cosine)``: the ``k`` words nearest to ``word`` (ties by word); none if it is unknown."""
        vectors = self.getVectors()
        row = vectors.where(F.col("word") == word).first()
        if row is None:
            return self.spark.createDataFrame([], "word string, cosine double")
        own = F.array(*[F.lit(float(x)) for x in row["vector"]])

        def dot(x, y):
            return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, p: s + p)

        length = F.sqrt(dot(F.col("vector"), F.col("vector")) * dot(own, own))
        return (vectors.where(F.col("word") != word)
                .select("word", F.when(length > 0, dot(F.col("vector"), own) / length).otherwise(0.0).alias("cosine"))
                .orderBy(F.desc("cosine"), "word").limit(k))

    def save(self, path: str) -> None:
        self.getVectors().write.mode("overwrite").parquet(f"{path}/vectors")
        meta = [(self.dim, self.input_col, self.features_col)]
        self.spark.createDataFrame(meta, "dim int, input_col string, features_col string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "WordTable":
        meta = spark.read.schema("dim int, input_col string, features_col string").json(f"{path}/meta").first()
        return WordTable(spark, path, meta["dim"], meta["input_col"], meta["features_col"])


class _Fit:
    """The tables of one fit in a shared folder: each is written once, a complete one is read again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path, Store(spark, path)

    def done(self, name: str) -> bool:
        return self.store.exists(f"{self.path}/{name}/_SUCCESS")

    def table(self, name: str, make, schema: str, by: str | None = None) -> DataFrame:
        if not self.done(name):
            writer = make().write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")


def fit_word_table(df: DataFrame, tokens_col: str = "comment", output_col: str = "result", dim: int = 128, min_count: int = 0,
                   window: int = WINDOW, negatives: int = NEGATIVES, epochs: int = EPOCHS, rate: float = RATE, seed: int = 42,
                   sentence: int = SENTENCE, words_per_bucket: int = WORDS_PER_BUCKET, pairs_per_block: int = PAIRS_PER_BLOCK,
                   min_buckets: int = MIN_BUCKETS, path: str | None = None, stop_after: int | None = None) -> WordTable | None:
    """Word vectors of all rows' token lists.

    ``path`` names the fit's folder (a fresh one by default). A fit stopped on the way goes on when called with its
    ``path`` and the same settings; other settings are refused. ``stop_after`` ends the call after so many steps
    (then None is returned). The last two steps' vectors are kept, older ones deleted.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "word-table")
    fit = _Fit(spark, path)
    settings = json.dumps(dict(dim=dim, min_count=min_count, window=window, negatives=negatives, epochs=epochs, rate=rate, seed=seed,
                               sentence=sentence, words_per_bucket=words_per_bucket, pairs_per_block=pairs_per_block,
                               min_buckets=min_buckets), sort_keys=True)
    if not fit.store.exists(f"{path}/settings.json"):
        fit.store.create(f"{path}/settings.json", settings)
    elif fit.store.read(f"{path}/settings.json") != settings:
        raise ValueError(f"{path} holds a fit with other settings")

    counts = fit.table("counts", lambda: word_counts(df, tokens_col, min_count), "word string, n long")
    met = fit.table("met", lambda: word_pairs(df, tokens_col, window, sentence), "a string, b string, n long")
    # A decimal's sum does not depend on the order of the rows.
    size = counts.agg(F.count("*"), F.sum(F.pow("n", F.lit(NOISE_POWER)).cast("decimal(28,6)"))).first()
    n_words, noise_total, n_met = size[0], float(size[1] or 1), met.count()
    buckets = max(min_buckets, math.ceil(n_words / words_per_bucket), math.ceil(math.sqrt(2 * n_met / pairs_per_block)))

    dealt = counts.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    number = F.row_number().over(Window.partitionBy("bucket").orderBy("word")) - 1
    words = fit.table("words", lambda: dealt.withColumn("i", number), "word string, n long, bucket int, i int")

    def ends():
        a = words.select(F.col("word").alias("a"), F.col("bucket").alias("ab"), F.col("i").alias("ai"))
        b = words.select(F.col("word").alias("b"), F.col("bucket").alias("bb"), F.col("i").alias("bi"))
        return met.join(a, "a").join(b, "b").select("ab", "ai", "bb", "bi", "n")

    numbered = fit.table("numbered", ends, "ab int, ai int, bb int, bi int, n long")
    both = directed(numbered, ["ab", "ai"], ["bb", "bi"])

    def slices():
        pairs = both.select(F.pmod(F.col("c_0") - F.col("w_0"), F.lit(buckets)).alias("stratum"), F.col("w_0").alias("bucket"),
                            F.col("w_1").alias("i"), F.col("c_1").alias("j"), F.col("n").cast("double").alias("n"))
        ordered = pairs.repartitionByRange("stratum", "bucket").sortWithinPartitions("stratum", "bucket", "i", "j")
        return ordered.mapInArrow(_pack, _SLICES)

    blocks = fit.table("blocks", slices, _SLICES, by="stratum")
    totals = both.groupBy(F.col("w_0").alias("bucket"), F.col("w_1").alias("i")).agg(F.sum("n").cast("double").alias("weight"))
    # Weights are taken relative to the mean pair, so that steps do not depend on the corpus's size.
    mean = (both.agg(F.avg("n")).first()[0]) or 1.0

    def first_bucket(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        n, bucket = len(frame), int(frame["bucket"].iloc[0])
        start = (np.random.default_rng([seed, bucket]).random((n, dim)) - 0.5) / dim
        out = []
        for kind, vec, freq in ((_WORD, start, frame["weight"].to_numpy(np.float64)),
                                (_CONTEXT, np.zeros((n, dim)), frame["n"].to_numpy(np.float64) ** NOISE_POWER)):
            data = np.concatenate([vec.ravel(), np.zeros(n), freq]).astype("<f4").tobytes()
            out.append((kind, bucket, n, data))
        return pd.DataFrame(out, columns=["kind", "bucket", "size", "data"])

    def start():
        rows = words.join(totals, ["bucket", "i"], "left").select("bucket", "i", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
        return rows.groupBy("bucket").applyInPandas(first_bucket, _PARAMS)

    last = max([int(n[5:]) for n in fit.store.names(path) if n.startswith("step=") and fit.done(n)], default=0)
    params = fit.table(f"step={last}", start, _PARAMS)

    def step(params: DataFrame, stratum: int, turn: int) -> DataFrame:
        here = blocks.where(F.col("stratum") == stratum)
        key = F.when(F.col("kind") == _CONTEXT, F.pmod(F.col("bucket") - stratum, F.lit(buckets))).otherwise(F.col("bucket"))
        rows = params.select(key.alias("_k"), "kind", "bucket", F.lit(0).alias("slice"), "size", "data").unionByName(
            here.select(F.col("bucket").alias("_k"), F.lit(_PAIRS).alias("kind"), "bucket", "slice", "size", "data"))

        def work(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["kind", "slice"])
            ends = frame[frame["kind"] != _PAIRS]
            if len(ends) == 2:
                (u, u_sq, u_n), (v, v_sq, noise) = (_bucket_of(s, d, dim) for s, d in zip(ends["size"], ends["data"]))
                parts = [(np.frombuffer(d, "<i4", s), np.frombuffer(d, "<i4", s, 4 * s), np.frombuffer(d, "<f4", s, 8 * s))
                         for s, d in zip(*(frame.loc[frame["kind"] == _PAIRS, c] for c in ("size", "data")))]
                i, j, w = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, "<f4") for k in range(3))
                mass = negatives * float(u_n.sum(dtype=np.float64)) * float(noise.sum(dtype=np.float64)) / noise_total / mean
                learn_block(u, u_sq, u_n, v, v_sq, noise, i, j, w / mean, mass, negatives, rate, [seed, turn, int(frame["_k"].iloc[0])])
                data = [np.concatenate([x.ravel(), sq, f]).tobytes() for x, sq, f in ((u, u_sq, u_n), (v, v_sq, noise))]
                ends = ends.assign(data=data)
            return ends[["kind", "bucket", "size", "data"]]     # a bucket without words leaves the other as it is

        return rows.repartition(buckets, "_k").groupBy("_k").applyInPandas(work, _PARAMS)

    steps = epochs * buckets if n_words else 0
    for turn in range(last + 1, steps + 1):
        if stop_after is not None and turn > stop_after:
            return None
        epoch, place = divmod(turn - 1, buckets)
        stratum = int(np.random.default_rng([seed, epoch]).permutation(buckets)[place])
        params = fit.table(f"step={turn}", lambda p=params, s=stratum, t=turn: step(p, s, t), _PARAMS)
        if turn >= 2:
            fit.store.delete(f"{path}/step={turn - 2}")

    def spread(frames):
        for frame in frames:
            for bucket, n, data in zip(frame["bucket"], frame["size"], frame["data"]):
                vec = _bucket_of(n, data, dim)[0]
                for a in range(0, n, BATCH):
                    part = vec[a:a + BATCH]
                    yield pd.DataFrame({"bucket": bucket, "i": np.arange(a, a + len(part), dtype=np.int32), "vector": list(part)})

    def vectors():
        rows = params.where(F.col("kind") == _WORD).select("bucket", "size", "data").mapInPandas(
            spread, "bucket int, i int, vector array<float>")
        return words.join(rows, ["bucket", "i"]).select("word", "vector")

    fit.table("vectors", vectors, "word string, vector array<float>")
    return WordTable(spark, path, dim, tokens_col, output_col)
