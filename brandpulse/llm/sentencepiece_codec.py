"""SentencePiece encoding and decoding of whole texts.

Inside a task the distinct units of a slice are concatenated and their suffixes sorted; every piece finds
its occurrences by binary search, the occurrences are laid out by position, and the encoding is relaxed
over them. For a BPE model relaxing means merging, round by round, the best pair that is a piece, which
gives the ids that the library gives; a best path over piece scores would not (see ``pieces``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import null_id, row_keys, slices
from brandpulse.llm.pieces import Encoder, Vocabulary, marked, unit_bounds

# Text bytes whose distinct units are indexed together.
TASK_SLICE = 1 << 20


def _encoder(v: Vocabulary, carried: list[str]):
    def encode(batches):
        enc = Encoder(v)
        for batch in batches:
            for part in slices(batch, limit=TASK_SLICE):
                data, off = marked([t.encode() for t in part.column("_t").to_pylist()])
                start, end, first = unit_bounds(v, data, off)
                ids, at, length = enc.units(data, start, end)
                total = np.zeros(len(length) + 1, np.int64)
                np.cumsum(length, out=total[1:])
                flat = ids[np.repeat(at - total[:-1], length) + np.arange(total[-1])]
                lists = pa.ListArray.from_arrays(pa.array(total[first].astype(np.int32)), pa.array(flat))
                yield pa.record_batch([*[part.column(c) for c in carried], lists], [*carried, "ids"])
    return encode


def sentencepiece_encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                         carry: Sequence[str] = ()) -> DataFrame:
    """``(id_col, text_col, carry..., ids array<int>)``: the library's ids of every whole text.

    Defined cases: null and empty texts have no ids; characters without a piece become their bytes; strings
    like ``<s>`` inside a text are ordinary text; rows are encoded one by one, so repeated rows get equal
    ids; a very long text is one slice, a very long unit is merged with a heap; an empty table gives no
    rows; other columns are not read. One map pass, no shuffle.
    """
    v = Vocabulary.load(model_path)
    rows = row_keys(docs, id_col, text_col, carry)
    carried = [c for c in rows.columns if c != "_h"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "_h")
    out = rows.select(*carried).mapInArrow(_encoder(v, carried), schema + ", ids array<int>")
    return out.select(null_id().alias(id_col), F.col("_t").alias(text_col),
                      *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "ids")


def _decoder(v: Vocabulary, names: list[str], at: int):
    blob = np.frombuffer(b"".join(v.table), np.uint8)
    size = np.array([len(t) for t in v.table], np.int64)
    begin = np.cumsum(size) - size

    def decode(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                lists = part.column(at)
                ids = lists.flatten().to_numpy()
                count = np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
                n = size[ids]
                flat = blob[np.repeat(begin[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                per = np.zeros(len(ids) + 1, np.int64)
                np.cumsum(n, out=per[1:])
                edge = per[np.append(0, np.cumsum(count))]
                raw = flat.tobytes()
                texts = [raw[x + (raw[x:x + 1] == b" "):y].decode("utf-8", "replace")
                         for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.record_batch([*[part.column(i) for i in range(part.num_columns)], pa.array(texts, pa.string())],
                                      [*names, "decoded"])
    return decode


def sentencepiece_decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of ``ids_col``, marks as spaces, the first space dropped.

    Null ids and no ids decode to the empty text. A column named ``decoded`` in the input is replaced.
    """
    v = Vocabulary.load(model_path)
    rows = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", decoded string"
    return rows.mapInArrow(_decoder(v, rows.columns, rows.columns.index(ids_col)), schema)
