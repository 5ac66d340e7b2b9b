"""Means of word values over token lists, for word tables of any size.

Lists are dealt to parts of about ``TOKENS_PER_PART`` tokens, copies of a list apart, a task for each part. A part needs the
values of its own distinct words only: (part, word) pairs meet the word table by a join, and the values found go to the part.
So a list crosses the network once, packed with the others that a batch sends to the part, and a word's value once for each part that holds the word, never once for each token. Only
lists' sums are grouped, never the lists, so no task sorts more of them than a part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.functions.text import array_input
from brandpulse.session import written

TOKENS_PER_PART = 1_000_000
# Tokens whose values are summed at a time in a task.
SLICE_TOKENS = 32_768


def list_key(tokens_col: str) -> dict[str, Column]:
    """The 128-bit hash of a token list. Hashes are never null, so no null check (which would run the tokens'
    expression again) is inferred."""
    return {"_k1": F.xxhash64(tokens_col), "_k2": F.xxhash64(F.lit(1), tokens_col)}


def _pack(batches):
    """Lists of a batch that go to one part as one packed row: a word once in its dictionary, all of it by zstd."""
    for batch in batches:
        of = batch.column("_p").to_numpy(zero_copy_only=False)
        order = np.argsort(of, kind="stable")
        lists, ends = _flat(batch.column("_t").take(pa.array(order)))
        keys = [batch.column(c).take(pa.array(order)) for c in ("_k1", "_k2")]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(of[order])) + 1, [len(of)]])
        parts, data = [], []
        for lo, hi in zip(edges[:-1], edges[1:]):
            if lo == hi:
                continue
            own = pa.ListArray.from_arrays(pa.array(ends[lo:hi + 1] - ends[lo], pa.int32()),
                                           lists.slice(ends[lo], ends[hi] - ends[lo]).dictionary_encode())
            table = pa.record_batch([k.slice(lo, hi - lo) for k in keys] + [own], ["_k1", "_k2", "_t"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(table)
            parts.append(int(of[order[lo]]))
            data.append(sink.getvalue().to_pybytes())
        if parts:
            yield pa.record_batch([pa.array(parts, pa.int64()), pa.array(data, pa.binary())], ["_p", "_data"])


def _flat(column) -> tuple[pa.Array, np.ndarray]:
    """A list column's entries in one array, and where each list starts and ends in it."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.concatenate([[0], np.cumsum(sizes)])


def _sums(values: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per list the sum of its tokens' values; ``at`` is a token's row in ``values``, whose last row is 0."""
    out = np.zeros((len(ends) - 1, values.shape[1]))
    lo = 0
    while lo < len(out):
        hi = max(int(np.searchsorted(ends, ends[lo] + SLICE_TOKENS, "right")) - 1, lo + 1)
        some = np.flatnonzero(ends[lo + 1:hi + 1] > ends[lo:hi]) + lo
        if len(some):
            part = values[at[ends[lo]:ends[hi]]].astype(np.float64)
            out[some] = np.add.reduceat(part, ends[some] - ends[lo], axis=0)
        lo = hi
    return out


def written_lists(keyed: DataFrame, tokens_col: str) -> DataFrame:
    """``keyed`` written once, with the size of its token lists and a number for each row (what ``list_sums`` takes)."""
    rows = keyed.withColumn(tokens_col, array_input(tokens_col))
    return written(rows.select("*", F.coalesce(F.size(tokens_col), F.lit(0)).alias("_size"),
                               F.monotonically_increasing_id().alias("_row")), "token-lists")


def list_sums(keyed: DataFrame, tokens_col: str, words: DataFrame, dim: int, tokens_per_part: int = TOKENS_PER_PART) -> DataFrame:
    """``(_k1, _k2, _n, _sum)`` for every different token list of ``keyed`` (which has the columns of ``list_key``).

    ``words`` is (``_w``, ``_v`` array of ``dim`` doubles or floats), a word once. ``_n`` counts all tokens, unknown and null ones
    too; an empty or null list has ``_n`` 0 and zeros. Rows of ``written_lists`` are not written again.
    """
    if "_row" not in keyed.columns:
        keyed = written_lists(keyed.select("_k1", "_k2", tokens_col), tokens_col)
    lists = keyed.select("_k1", "_k2", F.col(tokens_col).alias("_t"), "_size", "_row")
    n = lists.agg(F.sum(F.greatest("_size", F.lit(0)))).first()[0] or 0
    parts = max(1, math.ceil(n / tokens_per_part))
    part = F.pmod(F.xxhash64("_k1", "_row"), F.lit(parts)).alias("_p")
    held = (lists.select(part, F.explode(F.array_compact("_t")).alias("_w")).distinct()
            .join(words.select("_w", "_v"), "_w").select("_p", "_w", "_v"))
    names = ["_k1", "_k2", "_n", "_sum"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.num_rows
        values = np.zeros((known + 1, dim))
        if known:
            values[:known] = _flat(right.column("_v"))[0].to_numpy(zero_copy_only=False).reshape(known, dim)
            names_of = right.column("_w").combine_chunks()
        out = []
        for data in left.column("_data"):
            for lists in pa.ipc.open_stream(data.as_buffer()):
                coded, ends = _flat(lists.column("_t"))
                # A word is looked up once for each dictionary; a null token has no number.
                at = pc.index_in(coded.dictionary, value_set=names_of) if known else pa.nulls(len(coded.dictionary), pa.int32())
                at = pc.fill_null(at.take(coded.indices), known).to_numpy(zero_copy_only=False)
                sums = _sums(values, at, ends)
                column = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, dim, dtype=np.int32)), pa.array(sums.ravel()))
                out.append(pa.record_batch([lists.column("_k1"), lists.column("_k2"), pa.array(np.diff(ends)), column], names))
        return pa.Table.from_batches(out, schema=pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("_n", pa.int64()),
                                                            ("_sum", pa.list_(pa.float64()))]))

    # A word that no list of the part holds is never sent, so a part without lists has no words either.
    packed = lists.select(part, "_k1", "_k2", "_t").mapInArrow(_pack, "_p long, _data binary")
    sums = (packed.repartition(parts, "_p").groupBy("_p")
            .cogroup(held.repartition(parts, "_p").groupBy("_p")).applyInArrow(work, "_k1 long, _k2 long, _n long, _sum array<double>"))
    return sums.groupBy("_k1", "_k2").agg(F.first("_n").alias("_n"), F.first("_sum").alias("_sum"))
