"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut into blocks of rows, and the components of a block into parts: a part is a node that
holds partial scores. Phase 1 gathers from every node its local list of best partial scores and takes
the k-th best total among them: a safe lower bound of the final k-th score. Phase 2 sends each query its
cutoff, bound / parts: a row that reaches the bound must reach the cutoff in one part at least, so
every node collects its entries above it. Phase 3 resolves the totals of those entries exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import scratch

PARTS = 2
BLOCK_ROWS = 1024      # candidates of a block
BLOCK_QUERIES = 2048   # queries of a block
# Up to so many blocks of a side travel alone; of more, so many travel to a task together (candidates, queries).
FREE_BLOCKS, GROUP_BLOCKS = 64, (16, 4)
_EXACT = 2.0 ** 53


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(_id, _v array<long>)``: floor(scale * x) of every component; rows with a null id, a null vector
    or a null or non-finite component take no part."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("_id"),
                    F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("_v")))


def _pack(rows: DataFrame, key: str, n_blocks: int, dim: int) -> DataFrame:
    """One row for each block: ids and the matrix (zero-padded to ``dim``) as bytes."""
    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_id", kind="stable")
        m = np.zeros((len(g), dim), np.int64)
        for i, v in enumerate(g["_v"]):
            m[i, :len(v)] = v
        return pd.DataFrame({key: [g[key].iloc[0]], "ids": [g["_id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()]})

    return (rows.withColumn(key, F.pmod(F.xxhash64("_id", "_v"), F.lit(n_blocks)).cast("int"))
            .groupBy(key).applyInPandas(pack, f"{key} int, ids binary, m binary"))


def _groups(n_blocks: int, size: int) -> int:
    return n_blocks if n_blocks <= FREE_BLOCKS else max(FREE_BLOCKS, -(-n_blocks // size))


def _met(cand: DataFrame, query: DataFrame, n_c: int, n_q: int) -> DataFrame:
    """Every block of candidates beside every block of queries.

    Blocks are dealt to groups, and a group of one side goes to every group of the other: what is moved is a block once for
    each group it meets. The copies that makes are not in the optimizer's estimate of a side's size, which may look small enough for
    a broadcast and would then stand whole on the driver, so the sides are merged.
    """
    g_c, g_q = _groups(n_c, GROUP_BLOCKS[0]), _groups(n_q, GROUP_BLOCKS[1])
    c = cand.withColumn("_gc", F.pmod("cb", F.lit(g_c))).withColumn("_gq", F.explode(F.sequence(F.lit(0), F.lit(g_q - 1))))
    q = query.withColumn("_gq", F.pmod("qb", F.lit(g_q))).withColumn("_gc", F.explode(F.sequence(F.lit(0), F.lit(g_c - 1))))
    return c.join(q.hint("merge"), ["_gc", "_gq"]).drop("_gc", "_gq")


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where every sum is exact, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _block(row: dict, dim: int) -> tuple[np.ndarray, ...]:
    q, x = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["ids"], np.int64)
    return q, np.frombuffer(row["qm"], np.int64).reshape(len(q), dim), x, np.frombuffer(row["m"], np.int64).reshape(len(x), dim)


_LOW = np.iinfo(np.int64).min


def _partials(q, qm, x, xm, parts):
    """Partial scores of every part; a query's own row is marked by the smallest long."""
    cuts = np.linspace(0, qm.shape[1], parts + 1).astype(int)
    own = q[:, None] == x[None, :]
    out = [_product(qm[:, a:b], xm[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return out, own


def _entries(q, x, total, hit) -> pa.RecordBatch:
    i, j = np.nonzero(hit)
    return pa.record_batch([pa.array(q[i]), pa.array(x[j]), pa.array(total[i, j])], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, parts: int = PARTS) -> DataFrame:
    """The ``k`` best rows of every query: ``(query_id long, rank int, vec_id long, score long)``.

    ``is_query`` is a condition on ``_id``; candidates are all rows with another id. Fewer than ``k``
    candidates: all. Ties go to the smaller id.

    Defined cases: null ids and vectors that are null or hold null or non-finite components take no part;
    an empty vector scores 0; shorter vectors count as padded with zeros; rows that agree in id and vector
    count once; a query id with several vectors is asked once, with its smallest; scores must fit a long;
    an empty table gives no rows; other columns are not read.

    Both sides are packed into blocks (rows of about half a megabyte) and meet by an equi-join on the pair of their
    groups' numbers (``_met``), never by a broadcast: a product is of one block of queries and one of candidates.
    """
    rows = scratch(quantised(vectors, id_col, vector_col, scale), "topk-vectors")
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("_v"))).first()
    dim = max(int(dim or 0), 1)
    asked = rows.where(is_query(F.col("_id"))).groupBy("_id").agg(F.min("_v").alias("_v"))
    n_c = max(1, -(-n // BLOCK_ROWS))
    n_q = max(1, -(-asked.count() // BLOCK_QUERIES))
    cand = scratch(_pack(rows.distinct(), "cb", n_c, dim), "topk-candidates")
    query = scratch(_pack(asked, "qb", n_q, dim).select("qb", F.col("ids").alias("qids"), F.col("m").alias("qm")),
                    "topk-queries")

    def local_lists(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q, qm, x, xm = _block(row, dim)
                part, own = _partials(q, qm, x, xm, parts)
                hit = np.zeros(own.shape, bool)
                for p in part:
                    seen = np.where(own, _LOW, p)
                    best = np.argpartition(seen, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k):]
                    np.put_along_axis(hit, best, True, axis=1)
                yield _entries(q, x, sum(part), hit & ~own)

    entry = "query_id long, vec_id long, score long"
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bound = (_met(cand, query, n_c, n_q).mapInArrow(local_lists, entry)
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
             .groupBy("query_id").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("found")))
    # A query with fewer than k entries has no bound: everything is collected (it has few candidates).
    bound = scratch(bound.select("query_id", F.when(F.col("found") >= k, F.col("bound")).alias("bound")), "topk-bounds")
    cutoffs = (
        asked.select(F.col("_id").alias("query_id"), F.pmod(F.xxhash64("_id", "_v"), F.lit(n_q)).cast("int").alias("qb"))
        .join(bound.hint("merge"), "query_id", "left")
        .groupBy("qb").agg(F.sort_array(F.collect_list(F.struct("query_id", "bound"))).alias("c"))
        .select("qb", F.transform("c", lambda s: F.coalesce(s["bound"], F.lit(_LOW))).alias("cut"))
    )

    def collect(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q, qm, x, xm = _block(row, dim)
                low = np.array(row["cut"], np.int64)
                part, own = _partials(q, qm, x, xm, parts)
                cut = (low + (parts - 1)) // parts   # rounded up: a sum of parts reaches low only if one reaches this
                hit = np.zeros(own.shape, bool)
                for p in part:
                    hit |= p >= cut[:, None]
                i, j = np.nonzero(hit & ~own)
                total = np.einsum("ij,ij->i", qm[i], xm[j])   # phase 3: exact totals of what was collected
                keep = total >= low[i]
                yield pa.record_batch([pa.array(q[i[keep]]), pa.array(x[j[keep]]), pa.array(total[keep])],
                                      ["query_id", "vec_id", "score"])

    asking = scratch(query.join(cutoffs.hint("merge"), "qb"), "topk-asking")     # a query's cutoff travels with it
    return (_met(cand, asking, n_c, n_q).mapInArrow(collect, entry)
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
