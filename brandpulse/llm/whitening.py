"""Embedding whitening with Spark MLlib's BlockMatrix.

Rows get consecutive indexes, are centred and cut into blocks of a BlockMatrix X. X transposed times X is the
scatter, a matrix of dimension x dimension whatever the number of rows; its eigenvectors are found on the
driver, and X times the whitening matrix, again as blocks, projects every row.

Entries are scaled to whole numbers first, so that sums and deviations are exact and centring loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import scratch

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BLOCK_BYTES = 2 << 20
BLOCK_COLS = 1024
# The scatter matrix is held on the driver: 8 bytes for each pair of dimensions.
MAX_DIM = 8192
# Eigenvalues below this share of the largest count as zero: no direction to whiten.
RANK_TOLERANCE = 1e-12


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``(_id, _x array<long>)``: floor(scale * entry) + offset; null vectors and those with a null or
    non-finite entry go."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).alias("_id"),
                    F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale) + F.lit(offset).cast("long")).alias("_x")))


def indexed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with consecutive ``_row`` numbers from 0, and their count.

    Partition and place are written with the rows, so the numbers are the same however often they are read;
    the sums over partitions run over one row for each partition.
    """
    held = scratch(rows.withColumn("_at", F.monotonically_increasing_id()), "whiten-rows")
    part = F.shiftrightunsigned("_at", 33)
    counts = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()  # one number a partition
    first, n = {}, 0
    for p, m in sorted(map(tuple, counts)):
        first[p], n = n, n + m
    starts = held.sparkSession.createDataFrame([(p, a) for p, a in first.items()], "_part long, _first long")
    numbered = held.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn("_row", F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_first"), n


def _sums(rows: DataFrame, dim: int, n: int) -> tuple[list[int], int]:
    """Exact sum of every dimension (a short vector's missing entries are zeros), and the largest deviation."""
    per = (rows.select(F.posexplode("_x").alias("i", "x")).groupBy("i")
           .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("m"),
                F.min("x").alias("low"), F.max("x").alias("high")).collect())
    total, widest = [0] * dim, 0
    for i, s, m, low, high in per:
        total[i] = int(s) + (n - m) * OFFSET
        low, high = (min(low, OFFSET), max(high, OFFSET)) if m < n else (low, high)
        widest = max(widest, abs(n * low - total[i]), abs(n * high - total[i]))
    return total, widest


def _multiply(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """``a * b`` with the middle dimension dealt over ``splits`` tasks; Python's ``multiply`` has no such argument and
    would gather all row blocks of a small product in one task."""
    model = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, int(splits))
    return BlockMatrix(model, a.rowsPerBlock, b.colsPerBlock)


def eigen(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling eigenvalues, unit eigenvectors as columns, and the share each explains (NaN: no variance)."""
    cov = (scatter + scatter.T) / (2.0 * n)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = float(np.trace(cov))
    return values, vectors, values / trace if trace > 0 else np.full(len(values), np.nan)


def _unpack(batches):
    """Blocks of projected rows to ``(_row, _w array<double>)``."""
    for batch in batches:
        for first, width, data in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            w = np.frombuffer(data, np.float64)
            rows = np.arange(first, first + len(w) // width)
            for a in range(0, len(rows), 8192):
                part = w[a * width:(a + 8192) * width]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(part) + 1, width), pa.int32()), pa.array(part))
                yield pa.record_batch([pa.array(rows[a:a + 8192]), lists], ["_row", "_w"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Whitened projections: ``(id_col, n long, deviation decimal, whitened array<double>, explained array<double>,
    identity_error double)``, one row for each vector that takes part.

    ``whitened[k]`` is the centred vector on eigenvector k of the covariance over the root of its eigenvalue,
    ``explained[k]`` that eigenvalue's share of the trace, ``deviation`` the exact sum of (n * x - S) ** 2, and
    ``identity_error`` the largest absolute entry of the whitened columns' covariance minus the identity.

    Defined cases: null vectors and those with a null or non-finite entry go; a null id stays; repeated rows
    are rows of their own; a shorter vector counts as padded with zero entries; where an eigenvalue is zero
    (``RANK_TOLERANCE``) the component's ``whitened`` is null and it is left out of ``identity_error``; one row
    or equal rows have no variance at all, ``explained`` and ``identity_error`` are then null; without a dimension
    or rows there is no row; entries must fit a long after scaling (``MAX_DIM`` dimensions at most); other
    columns are not read.
    """
    spark = vectors.sparkSession
    rows, n = indexed(scaled(vectors, id_col, vector_col))
    id_type = rows.schema["_id"].dataType
    dim = rows.agg(F.max(F.size("_x"))).first()[0] or 0
    if dim > MAX_DIM:
        raise ValueError(f"{dim} dimensions; at most {MAX_DIM}")
    k = min(components, dim)
    if not k:
        return spark.createDataFrame([], f"`{id_col}` {id_type.simpleString()}, n long, deviation decimal(38,0), "
                                     "whitened array<double>, explained array<double>, identity_error double")
    total, widest = _sums(rows, dim, n)
    padded = F.concat("_x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(dim) - F.size("_x")))
    # n * x - S, exact, as longs where they and the sum of their squares fit one, else as decimals.
    kind = "long" if widest * widest * dim < 2 ** 62 and n * (2 ** 40) < 2 ** 62 else "decimal(38,0)"
    sums = F.from_json(F.lit(str(total)), f"array<{kind}>")
    off = F.zip_with(padded, sums, lambda x, s: (x.cast(kind) * F.lit(n).cast(kind) - s).cast(kind))
    square = lambda a, d: (a + d * d).cast(kind)
    rows = rows.select("_id", "_row", off.alias("_off"))
    centred = rows.select("_row", array_to_vector(F.transform("_off", lambda d: d.cast("double") / F.lit(float(n)))).alias("_v"))
    centred = MLUtils.convertVectorColumnsFromML(centred, "_v")
    cols = min(dim, BLOCK_COLS)
    per_block = max(64, BLOCK_BYTES // (8 * cols))
    blocks = -(-n // per_block)
    x = IndexedRowMatrix(centred, n, dim).toBlockMatrix(per_block, cols)
    scatter = _multiply(x.transpose(), x, blocks).toLocalMatrix().toArray()
    values, axes, explained = eigen(scatter, n, k)
    full = int((values > max(values[0], 0.0) * RANK_TOLERANCE).sum()) if values[0] > 0 else 0
    scale = np.zeros(k)
    scale[:full] = 1.0 / np.sqrt(values[:full])
    w = axes * scale
    parts = [((i, 0), Matrices.dense(len(w[a:a + cols]), k, w[a:a + cols].T.ravel().tolist()))
             for i, a in enumerate(range(0, dim, cols))]
    projector = BlockMatrix(spark.sparkContext.parallelize(parts, 1), cols, k, dim, k)
    projected = x.multiply(projector)

    def packed(block):
        (i, _), m = block
        m = m if isinstance(m, DenseMatrix) else m.toDense()
        return i * per_block, k, m.toArray().astype(np.float64).tobytes()

    table = spark.createDataFrame(projected.blocks.map(packed), "first long, width int, data binary")
    lists = scratch(table.mapInArrow(_unpack, "_row long, _w array<double>"), "whiten-projected")
    error = identity_error(lists, full)
    known = F.transform("_w", lambda v, i: F.when(i < full, v))
    shares = F.array(*[F.lit(None if np.isnan(e) else float(e)).cast("double") for e in explained])
    deviation = F.aggregate("_off", F.lit(0).cast(kind), square).cast("decimal(38,0)")
    return (rows.select("_id", "_row", deviation.alias("_dev")).join(lists, "_row")
            .select(F.col("_id").alias(id_col), F.lit(n).cast("long").alias("n"), F.col("_dev").alias("deviation"),
                    known.alias("whitened"), shares.alias("explained"), F.lit(error).cast("double").alias("identity_error")))


def identity_error(lists: DataFrame, width: int) -> float | None:
    """Largest absolute entry of the covariance of ``_w``'s first ``width`` columns minus the identity (centred first)."""
    if not width:
        return None
    means = lists.agg(*[F.avg(F.col("_w")[i]).alias(f"m{i}") for i in range(width)]).first()
    off = lists.select(*[(F.col("_w")[i] - F.lit(means[i])).alias(f"c{i}") for i in range(width)])
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    got = off.agg(*[F.avg(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[a] - (i == j)) for a, (i, j) in enumerate(pairs))
