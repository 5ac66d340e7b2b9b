"""Token counts from composable maps of chunks of text.

No finite transducer is compiled: the state between two bytes is the unit read so far, and a unit's token count comes
from the piece encoder (each distinct unit of a task once). A chunk of text is a map of such states: whatever state
it is entered in, after its first cut the rest is fixed. The map is (bytes up to the first cut, tokens between cuts,
bytes after the last cut); maps compose associatively, and the chunks of a long text are reduced in a tree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import null_id, row_keys, scratch
from brandpulse.llm.pieces import MARK_BYTES, Encoder, Vocabulary

CHUNK_BYTES = 1 << 18
SLICE_BYTES = 1 << 20
FAN_IN = 64


class Transducer:
    """Maps of chunks, and their composition."""

    def __init__(self, v: Vocabulary):
        self.v, self.encoder = v, Encoder(v)

    def maps(self, chunks: list[bytes]) -> list[tuple[bytes, bool, int, bytes]]:
        """``(head, cut, count, tail)`` of every chunk; without a cut everything is head."""
        data = np.frombuffer(b"".join(chunks), np.uint8)
        off = np.zeros(len(chunks) + 1, np.int64)
        np.cumsum([len(c) for c in chunks], out=off[1:])
        if not len(data):
            return [(b"", False, 0, b"")] * len(chunks)
        cut = np.zeros(len(data), bool)
        cut[1:] = self.v.is_cut(data[:-1], data[1:])
        cut[off[(off < len(data))]] = False       # a chunk's first byte belongs to its head
        at = np.flatnonzero(cut)
        first = np.searchsorted(at, off)
        # Whole units: from one cut to the next in the same chunk.
        chunk = np.repeat(np.arange(len(chunks)), np.diff(first))
        inner = np.flatnonzero(chunk[1:] == chunk[:-1])
        _, _, length = self.encoder.units(data, at[inner], at[inner + 1]) if len(inner) else (0, 0, np.zeros(0, np.int64))
        count = np.bincount(chunk[inner], weights=length, minlength=len(chunks)).astype(np.int64)
        out = []
        for i, c in enumerate(chunks):
            if first[i] == first[i + 1]:
                out.append((c, False, 0, b""))
            else:
                out.append((c[:at[first[i]] - off[i]], True, int(count[i]), c[at[first[i + 1] - 1] - off[i]:]))
        return out

    def tokens(self, units: list[bytes]) -> np.ndarray:
        """Emissions of whole units."""
        data = np.frombuffer(b"".join(units), np.uint8)
        end = np.cumsum([len(u) for u in units], dtype=np.int64)
        start = end - np.array([len(u) for u in units], np.int64)
        full = end > start
        out = np.zeros(len(units), np.int64)
        if full.any():
            out[full] = self.encoder.units(data, start[full], end[full])[2]
        return out

    def compose(self, maps: list[tuple[bytes, bool, int, bytes]]) -> tuple[bytes, bool, int, bytes]:
        """The map of chunks in order. Open pieces are gathered, so that joining is linear in their bytes."""
        head, cut, count, open_, units = [], False, 0, [], []
        last = -1

        def shut():
            nonlocal cut, open_
            if cut:
                units.append(b"".join(open_))
            else:
                head[:] = open_
            cut, open_ = True, []

        for h, c, n, t in maps:
            if not h and not c:
                continue
            if last >= 0 and self.v.is_cut(np.array([last]), np.array([h[0] if h else t[0]]))[0]:
                shut()
            open_.append(h)
            if c:
                shut()
                count += n
                open_ = [t]
            last = (t or h)[-1]
        if not cut:
            return b"".join(open_), False, 0, b""
        return b"".join(head), True, count + int(self.tokens(units).sum()), b"".join(open_)

    def close(self, maps: list[tuple[bytes, bool, int, bytes]]) -> np.ndarray:
        """Token counts of whole texts from their maps, entered at the start and ended."""
        ends = self.tokens([x for m in maps for x in (m[0], m[3])])
        return np.array([m[2] for m in maps], np.int64) + ends[::2] + ends[1::2]


_MAP = "_r long, _d long, n_bytes long, chunk long, head binary, cut boolean, count long, tail binary, n_tokens long"
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.int64()]


def _pieces(text: bytes, size: int) -> list[bytes]:
    """Cut after at most ``size`` bytes, between characters."""
    out, a = [], 0
    while a < len(text):
        b = min(len(text), a + size)
        while b < len(text) and (text[b] & 0xC0) == 0x80:
            b -= 1
        out.append(text[a:b])
        a = b
    return out


def _mapper(v: Vocabulary, chunk_bytes: int, carried: list[str]):
    def run(batches):
        t = Transducer(v)
        for batch in batches:
            rows, size = [], 0
            for who in zip(*[batch.column(c).to_pylist() for c in ("_r", "_d", "_t")]):
                rows.append(who)
                size += len(who[2])
                if size >= SLICE_BYTES:
                    yield _map(t, rows, chunk_bytes)
                    rows, size = [], 0
            if rows:
                yield _map(t, rows, chunk_bytes)
    return run


def _map(t: Transducer, rows: list, chunk_bytes: int):
    chunks, who = [], []
    for r, d, text in rows:
        raw = text.encode()
        seen = b" " + raw.replace(MARK_BYTES, b" ") if raw else b""
        parts = _pieces(seen, chunk_bytes) or [b""]
        for i, p in enumerate(parts):
            chunks.append(p)
            who.append((r, d, len(raw), i if len(parts) > 1 else -1))
    maps = t.maps(chunks)
    single = [i for i, w in enumerate(who) if w[3] < 0]
    total = [None] * len(who)
    for i, n in zip(single, t.close([maps[i] for i in single])):
        total[i] = int(n)
        maps[i] = (None, None, None, None)
    columns = [*zip(*who), *zip(*maps), total]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, _KINDS)],
                           ["_r", "_d", "n_bytes", "chunk", "head", "cut", "count", "tail", "n_tokens"])


def _composer(v: Vocabulary, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        t = Transducer(v)
        rows = rows.sort_values("chunk")
        one = t.compose(list(zip(rows["head"], rows["cut"], rows["count"], rows["tail"])))
        out = rows.iloc[:1].copy()
        out["chunk"] = out["chunk"] // FAN_IN
        out["head"], out["cut"], out["count"], out["tail"] = [one[0]], one[1], one[2], [one[3]]
        out["n_tokens"] = int(t.close([one])[0]) if last else None
        return out.drop(columns="_g", errors="ignore")
    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 carry: Sequence[str] = (), limit: int = 4096, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(id_col, n_bytes long, n_tokens long, over_limit boolean)`` for every whole text, as the library counts.

    Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; texts
    longer than ``chunk_bytes`` are cut into chunks whose maps are composed ``FAN_IN`` at a time over the
    cluster; an empty table gives no rows; other columns are not read.
    """
    v = Vocabulary.load(model_path)
    rows = row_keys(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("_r"), "_d", "_t")
    maps = scratch(rows.mapInArrow(_mapper(v, chunk_bytes, []), _MAP), "token-maps")
    long = maps.where("chunk >= 0")
    most = long.agg(F.max("chunk")).first()[0]
    parts = [maps.where("chunk < 0")]
    if most is not None:
        levels = max(1, math.ceil(math.log(most + 1, FAN_IN) - 1e-9))
        for level in range(levels):
            long = (long.withColumn("_g", F.floor(F.col("chunk") / FAN_IN))
                    .groupBy("_r", "_g").applyInPandas(_composer(v, level == levels - 1), _MAP))
        parts.append(long)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(null_id().alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
