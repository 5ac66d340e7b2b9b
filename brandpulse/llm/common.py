"""Helpers shared by the llm operators: row keys, shared scratch tables, and byte-level word
splitting and hashing in numpy (used inside Arrow map tasks, one bounded slice at a time).

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; in UTF-8 this equals the regular
expression ``[^\\x20\\x09-\\x0D]+`` on code points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.session import scratch_path

# A null id sorts below every other id and is one of its own.
NULL_ID = -(2 ** 63)
# Text bytes handled at once inside a task (a longer single text is one slice).
SLICE_BYTES = 1 << 20


def id_key(id_col: str) -> Column:
    """The document id as a non-null long (null: the smallest long)."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def row_keys(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """``(_d, _h, _t, carry...)``: id key, hash of the text, text (null: empty).

    ``(_d, _h)`` names a row in later joins; rows that agree in both are repeated rows and share
    every decision that is made per text. Only the named columns are read, so extra columns cannot clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(id_key(id_col).alias("_d"), F.xxhash64(text).alias("_h"), text.alias("_t"),
                       *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])


def null_id(col: str = "_d") -> Column:
    """The id back from its key."""
    return F.when(F.col(col) != F.lit(NULL_ID), F.col(col))


def one_thread(spark) -> None:
    """Let numpy's matrix products in Python workers use the one core of their task, not every core of the executor.

    (Several threads spin on each other's products of a few thousand rows: twice the CPU time for no gain.)
    """
    spark.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it from there (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# numpy: hashing

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (shift, xor and odd multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def _stream(seed: int, n: int) -> np.ndarray:
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + _U(seed << 32)) * _U(0x9E3779B97F4A7C15))


# Fixed pseudo-random numbers: one per byte value, one odd number per place in a run of words.
def byte_table(seed: int = 1) -> np.ndarray:
    return _stream(seed, 256)


def odd_numbers(n: int, seed: int = 2) -> np.ndarray:
    return _stream(seed, n) | _U(1)


# Hashes of runs are polynomials over the prime field of 2**31 - 1, in two lanes with bases of their own. (Sums
# modulo 2**64 would be cheaper, but there long runs of two letters in certain orders agree whatever the base.)
_P = _U(2 ** 31 - 1)
_BASES = (1_220_703_125, 1_583_458_089)
_SHIFT = _U(31)
_CHUNK = 1 << 14
_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """``x`` in place to a smaller number of the same residue (twice: to the residue or, at most, the prime more)."""
    high = x >> _SHIFT
    x &= _P
    x += high
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out, done = np.ones(max(n, 1), np.uint64), 1
    while done < n:
        m = min(done, n - done)
        out[done:done + m] = (out[:m] * _U(pow(base, done, int(_P)))) % _P
        done += m
    return out[:n]


def powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**i`` and ``B**-i`` of a lane's base for ``i < n``; those for a usual slice are kept."""
    if lane in _KEPT and n <= len(_KEPT[lane][0]):
        return _KEPT[lane][0][:n], _KEPT[lane][1][:n]
    size = max(n, SLICE_BYTES + (1 << 16))
    both = _powers(_BASES[lane], size), _powers(pow(_BASES[lane], -1, int(_P)), size)
    if size <= 2 * SLICE_BYTES:
        _KEPT[lane] = both
    return both[0][:n], both[1][:n]


class Runs:
    """Hashes of any runs of 64-bit values, from prefix sums of ``value * B**i``.

    Equal for equal runs. Two given unequal runs of n values collide with probability about 2**-62 over the choice of
    the bases, and at most (n / 2**31) ** 2 whatever the runs are; where a hash decides alone, this is the chance
    of error.
    """

    def __init__(self, values: np.ndarray):
        self._prepare(len(values), [lambda some, k=k: (values[some] >> _U(33 * k)) & _P for k in (0, 1)])

    def _prepare(self, n: int, lanes) -> None:
        """``lanes`` give the numbers below the prime of a range of values, a new array each time."""
        self._sums, self._downs = [], []
        high = np.empty(_CHUNK, np.uint64)
        for lane, numbers in enumerate(lanes):
            up, down = powers(lane, n + 1)
            total = np.zeros(n + 1, np.uint64)
            for a in range(0, n, _CHUNK):          # pieces that stay in the cache
                x = numbers(slice(a, a + _CHUNK))
                x *= up[a:a + len(x)]
                np.right_shift(x, _SHIFT, out=high[:len(x)])
                x &= _P
                np.add(x, high[:len(x)], out=total[a + 1:a + 1 + len(x)])
            self._sums.append(np.cumsum(total, out=total))
            self._downs.append(down)

    @staticmethod
    def _mixed(lanes: list[tuple[np.ndarray, np.ndarray]], length) -> np.ndarray:
        """Differences of prefix sums, brought back to the first place, as one hash."""
        out = []
        for x, down in lanes:
            x = _fold(_fold(x))
            x *= down
            x = _fold(_fold(x))
            out.append(np.subtract(x, _P, out=x, where=x >= _P))
        out[1] <<= _U(32)
        out[0] |= out[1]
        out[0] += length
        return mix64(out[0])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed([(t[end] - t[start], d[start]) for t, d in zip(self._sums, self._downs)],
                           (end - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15))

    def fixed(self, width: int) -> np.ndarray:
        """Hash of every run of ``width`` values, by start."""
        n = max(0, len(self._sums[0]) - width)
        out = np.empty(n, np.uint64)
        for a in range(0, n, _CHUNK):
            b = min(a + _CHUNK, n)
            out[a:b] = self._mixed([(t[a + width:b + width] - t[a:b], d[a:b]) for t, d in zip(self._sums, self._downs)], _U(0))
        return out


class Rolling(Runs):
    """Hashes of any byte ranges of one array."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        tables = [(byte_table(seed) >> _U(33 * k)) & _P for k in (0, 1)]
        self._prepare(len(data), [lambda some, t=t: t[data[some]] for t in tables])


# ---------------------------------------------------------------------------
# numpy: texts of an Arrow column as one byte array

def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string or binary array without nulls, without a copy."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch, column: str = "_t", limit: int = SLICE_BYTES) -> Iterator:
    """Cut a record batch so that the texts of a slice take about ``limit`` bytes (one row at least)."""
    _, off = text_bytes(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first)``: byte bounds of every word; words of text i are ``first[i]:first[i+1]``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    space = _SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = space[1:]
    inner = off[(off > 0) & (off < len(data))]
    before[inner] = True
    after[inner - 1] = True
    word = ~space
    start = np.flatnonzero(word & before)
    end = np.flatnonzero(word & after) + 1
    return start, end, np.searchsorted(start, off)


def run_hashes(words: np.ndarray, first: np.ndarray, width: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` consecutive words that stays in one text: ``(hash, place of the first word)``."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    odd = odd_numbers(width, seed)
    acc = words[:n] * odd[0]
    for j in range(1, width):
        acc = acc + words[j:j + n] * odd[j]
    inside = np.ones(len(words), bool)
    for j in range(1, width):  # a run may not start in the last width-1 words of a text
        at = first[1:] - j
        inside[at[at >= first[:-1]]] = False
    place = np.flatnonzero(inside[:n])
    return mix64(acc[place]), place
