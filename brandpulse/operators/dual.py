"""Linear hinge-loss model in few jobs: dual coordinate ascent inside partitions.

The training rows are packed into blocks once. In a round every block takes its dual variables and the common
weights, ascends the dual problem over its own rows (several passes, no communication), and returns the change of
the weights; the driver adds the changes. Blocks scale their steps for the number of blocks that add theirs
at the same time, so the sum never overshoots. The same round measures the loss of the weights it started from,
and with the dual value that is the duality gap: an upper bound of the distance to the optimum, and the stop.

A round reads the blocks with their dual variables and writes them to the shared folder with the new ones; the round
before is deleted then, so two stand there at most. The driver holds the weights and one change for each block of
``BLOCK_ROWS`` rows, so all rows take part, however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.session import scratch_path, shuffles_freed
from brandpulse.sinks.keyed import Store

BLOCK_ROWS = 65_536
MAX_ROUNDS = 40
LOCAL_PASSES = 10
# Duality gap, relative to the objective, at which a fit is done.
TOLERANCE = 1e-3


@dataclass
class DualFit:
    weights: list[float]
    objective: float      # mean hinge loss + reg / 2 * |weights| ** 2
    gap: float            # objective minus the dual value: how far from the optimum at most
    rounds: int           # Spark jobs after packing


_BLOCKS = "block long, n long, y binary, x binary"
_STATE = f"{_BLOCKS}, alpha binary, loss double, held double, change binary"


def _pack(batches):
    """Rows of a task, sorted by their part, as blocks: label signs and features as bytes. A block holds rows of one part."""
    xs, ys, n, part, number = [], [], 0, None, 0

    def block():
        x, y = np.concatenate(xs), np.concatenate(ys)
        return pa.record_batch([pa.array([(part << 32) + number]), pa.array([len(y)]), pa.array([y.tobytes()]), pa.array([x.tobytes()])],
                               ["block", "n", "y", "x"])

    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
        of = batch.column("p").to_numpy(zero_copy_only=False)
        width = len(x) // batch.num_rows
        edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
        for lo, hi in zip(edges[:-1], edges[1:]):
            if part is not None and part != int(of[lo]):
                if n:
                    yield block()
                xs, ys, n, number = [], [], 0, 0
            part = int(of[lo])
            while lo < hi:
                take = min(hi - lo, BLOCK_ROWS - n)
                xs.append(x[lo * width:(lo + take) * width])
                ys.append(y[lo:lo + take])
                n, lo = n + take, lo + take
                if n == BLOCK_ROWS:
                    yield block()
                    xs, ys, n, number = [], [], 0, number + 1
    if n:
        yield block()


def packed_blocks(rows: DataFrame, features_col: str, label_col: str, parts: int | None = None) -> DataFrame:
    """``(block, n, y, x)``: rows of an array of doubles and a 0/1 label as blocks of label signs and features, written once.

    With ``parts`` the rows are dealt to so many parts by hash and sorted there, and blocks depend on the rows alone;
    otherwise a part is a partition as it is.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "hinge-blocks")
    points = rows.select(F.col(features_col).cast("array<double>").alias("x"), (2.0 * F.col(label_col) - 1.0).alias("y"))
    if parts is None:
        points = points.withColumn("p", F.spark_partition_id().cast("long"))
    else:
        points = (points.withColumn("p", F.pmod(F.xxhash64("x", "y"), F.lit(parts)))
                  .repartition(parts, "p").sortWithinPartitions("p", "y", "x"))
    with shuffles_freed(spark):
        points.mapInArrow(_pack, _BLOCKS).write.parquet(path)
    return spark.read.schema(_BLOCKS).parquet(path)


def ascend(x: np.ndarray, y: np.ndarray, alpha: np.ndarray, w: np.ndarray, scale: float, share: int, passes: int,
           seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Dual variables after ``passes`` over the rows in random order, and the change of the weights.

    ``scale`` is reg * rows; ``share`` the number of blocks that add their changes. A step sets one dual variable to
    its best value in [0, 1] for the weights as this block sees them.
    """
    rng = np.random.default_rng(seed)
    signed, alpha = x * y[:, None], alpha.copy()
    size = np.einsum("ij,ij->i", x, x)
    step = np.where(size > 0, scale / (share * np.maximum(size, 1e-300)), 0.0)
    seen, start = w.copy(), alpha.copy()
    for _ in range(passes):
        for i in rng.permutation(len(y)):
            a = min(max(alpha[i] + (1.0 - signed[i] @ seen) * step[i], 0.0), 1.0) if size[i] > 0 else 1.0
            if a != alpha[i]:
                seen += (share * (a - alpha[i]) / scale) * signed[i]
                alpha[i] = a
    return alpha, (alpha - start) @ signed / scale


def hinge_dual(rows: DataFrame, features_col: str, label_col: str, dim: int, reg: float, tolerance: float = TOLERANCE,
               max_rounds: int = MAX_ROUNDS, passes: int = LOCAL_PASSES, seed: int = 1, parts: int | None = None) -> DualFit:
    """Minimise mean hinge loss + reg / 2 * |w| ** 2 (no intercept) over rows with an array of ``dim`` doubles and a 0/1 label.

    The result depends on the rows and their ``parts`` (without these on the partitions), not on the cluster. Without
    rows the weights are 0.
    """
    spark = rows.sparkSession
    blocks = packed_blocks(rows, features_col, label_col, parts)
    n, share = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Weights and dual variables of 0: every row's loss is 1, the dual value 0.
    w, best = np.zeros(dim), DualFit([0.0] * dim, 1.0, 1.0, 1 if n else 0)
    if not n or best.gap <= tolerance * best.objective:
        return best
    root = scratch_path(spark, "hinge-rounds")
    store = Store(spark, root)
    state = blocks.withColumn("alpha", F.lit(b""))
    for round_no in range(1, max_rounds + 1):
        def work(batches, w=w, seed=seed + round_no):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in ("block", "n", "y", "x", "alpha")}
                    block, count = row["block"].as_py(), row["n"].as_py()
                    y = np.frombuffer(row["y"].as_buffer(), np.float64)
                    x = np.frombuffer(row["x"].as_buffer(), np.float64).reshape(count, dim)
                    held = np.frombuffer(row["alpha"].as_buffer(), np.float64) if round_no > 1 else np.zeros(count)
                    loss = float(np.maximum(0.0, 1.0 - y * (x @ w)).sum())
                    alpha, change = ascend(x, y, held, w, reg * n, share, passes, seed + (block & 0xFFFF) * 7919 + (block >> 32))
                    yield pa.record_batch(
                        [batch.column(c).slice(i, 1) for c in ("block", "n", "y", "x")]
                        + [pa.array([v]) for v in (alpha.tobytes(), loss, float(held.sum()), change.tobytes())],
                        ["block", "n", "y", "x", "alpha", "loss", "held", "change"])

        state.mapInArrow(work, _STATE).write.parquet(f"{root}/{round_no}")
        state = spark.read.schema(_STATE).parquet(f"{root}/{round_no}")
        if round_no > 1:
            store.delete(f"{root}/{round_no - 1}")
        got = sorted(state.select("block", "loss", "held", "change").collect())        # one row a block
        state = state.select("block", "n", "y", "x", "alpha")
        objective = sum(r["loss"] for r in got) / n + reg / 2.0 * float(w @ w)
        dual = sum(r["held"] for r in got) / n - reg / 2.0 * float(w @ w)
        if objective < best.objective:
            best = DualFit(w.tolist(), objective, objective - dual, round_no + 1)
        else:
            best = DualFit(best.weights, best.objective, min(best.gap, best.objective - dual), round_no + 1)
        if best.gap <= tolerance * best.objective:
            break
        w = w + sum(np.frombuffer(r["change"], np.float64) for r in got)
    store.delete(root)
    return best
