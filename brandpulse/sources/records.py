"""Records that do not end at line ends, read by many tasks.

Spark's text reader cuts a file into byte ranges and gives each range the lines that start in it, whatever
the line separator is. Two kinds of files have records that a line alone does not delimit:

* concatenated JSON objects, with or without line breaks between or inside them: read with ``}`` as the
  separator, a record ends at the ``}`` that brings the depth back to 0 outside strings;
* CSV with line breaks in quoted fields: a record ends at the line end where the quotes so far are even.

Both are small state machines, and what a range does to the state is a small map that composes: quote parity,
and for JSON the depth as ``d -> max(d + a, b)`` for either parity. One pass computes the map of every range, the
maps of a file are composed in order (one row for each range), and a second pass cuts the records, now knowing
each range's state at its start. A record that crosses ranges leaves its pieces under the range where it
began; those are put together by a shuffle. No task holds more than one batch of lines and one record.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.session import scratch_path

_QUOTE, _SLASH, _OPEN, _CLOSE = b'"'[0], b"\\"[0], b"{"[0], b"}"[0]
_NEVER = 1 << 60
# What a range does to the state, for even and odd quotes at its start: change of depth, lowest depth on the way,
# lowest depth at a line end outside strings (``_NEVER``: there is none).
_MAP = ("file long, start long, size long, bytes long, odd boolean, "
        "a0 long, low0 long, end0 long, a1 long, low1 long, end1 long")
_STATE = "file long, start long, odd boolean, depth long, owner long, ended boolean"


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``(v, file, start, size)``: the bytes between separators, in order within each range of a file."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("value").cast("binary").alias("v"), F.xxhash64(meta["file_path"]).alias("file"),
        meta["file_block_start"].alias("start"), meta["file_size"].alias("size"))


@dataclass(frozen=True)
class Machine:
    """``json``: braces, strings and backslash escapes; else only the parity of quotes."""

    json: bool

    @property
    def sep(self) -> bytes:
        return b"}" if self.json else b"\n"

    def scan(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """At every line's end, its separator included: whether the quotes so far are odd; and, for either parity at
        the start, change of depth and lowest depth so far, as ``(parity, line, 2)`` (zeros for CSV)."""
        data = np.frombuffer(self.sep.join(lines) + self.sep, np.uint8)
        ends = np.cumsum([len(x) + 1 for x in lines]) - 1
        quote = data == _QUOTE
        out = np.zeros((2, len(lines), 2), np.int64)
        if not self.json:
            return np.cumsum(quote)[ends] % 2 == 1, out
        slash = data == _SLASH
        if slash.any():
            # A quote is escaped by an odd run of backslashes right before it.
            place = np.arange(len(data))
            other = np.maximum.accumulate(np.where(slash, -1, place))
            before = np.concatenate([[-1], other[:-1]])
            quote &= (place - 1 - before) % 2 == 0
        odd = np.cumsum(quote) % 2 == 1
        brace = (data == _OPEN).astype(np.int64) - (data == _CLOSE)
        for p in (0, 1):
            depth = np.cumsum(np.where(odd == bool(p), brace, 0))
            out[p, :, 0] = depth[ends]
            out[p, :, 1] = np.minimum.accumulate(np.minimum(depth, 0))[ends]
        return odd[ends], out


def _ranges(batches, columns: list[str]) -> Iterator[tuple[tuple, list[bytes]]]:
    """Runs of lines of one range, in order, with the values of ``columns`` (constant in a range)."""
    for batch in batches:
        v = batch.column("v").to_pylist()
        held = [batch.column(c).to_pylist() for c in columns]
        file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
        cut = (np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist()
        for a, b in zip([0, *cut], [*cut, len(v)]):
            if b > a:
                yield tuple(h[a] for h in held), v[a:b]


def _mapper(machine: Machine):
    def run(batches):
        held: dict = {}
        for key, lines in _ranges(batches, ["file", "start", "size"]):
            odd, depth = machine.scan(lines)
            m = held.setdefault(key, [0, False, [(0, 0, _NEVER), (0, 0, _NEVER)]])
            m[0] += sum(len(x) + 1 for x in lines)
            for p in (0, 1):
                total, low, end = m[2][p]
                q = p ^ int(m[1])                       # the parity at the start of these lines
                outside = odd == bool(q)
                lowest = int(depth[q, outside, 0].min()) if outside.any() else _NEVER
                m[2][p] = (total + int(depth[q, -1, 0]), min(low, total + int(depth[q, -1, 1])), min(end, total + lowest))
            m[1] ^= bool(odd[-1])
        if held:
            rows = [[*k, size, odd, *[x for per in maps for x in per]] for k, (size, odd, maps) in held.items()]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=[f.split()[0] for f in _MAP.split(", ")]), preserve_index=False)
    return run


def _compose(ranges: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file in order to the state at each one's start.

    ``owner`` is the range in which the record that is open there began (-1: none is open).
    """
    ranges = ranges.sort_values("start", kind="stable")
    odd, depth, owner, out = False, 0, -1, []
    for r in ranges.itertuples(index=False):
        out.append([r.file, r.start, odd, depth, owner, True])
        change, low, end = (r.a1, r.low1, r.end1) if odd else (r.a0, r.low0, r.end0)
        begun = (not odd and depth == 0) or depth + end <= 0
        owner = r.start if begun else owner
        odd, depth = odd ^ bool(r.odd), max(depth + change, change - low)
        if not odd and depth == 0:
            owner = -1
    # Whether a separator follows the file's last line; the size of a compressed file says nothing, then it
    # is taken to follow if it closes the last record.
    over = int(ranges["bytes"].sum()) - int(ranges["size"].iloc[0])
    out[-1][-1] = over == 0 if over in (0, 1) else not odd and depth == 0
    return pd.DataFrame(out, columns=[f.split()[0] for f in _STATE.split(", ")])


class _Cutter:
    """Cuts the lines of one range into records, given the state at its start."""

    def __init__(self, machine: Machine, key: tuple):
        self.machine = machine
        self.file, self.start, self.odd, self.depth, self.owner, self.ended = key
        if self.odd is None:
            raise RuntimeError("the ranges of the files changed between the two passes; fix spark.sql.files.minPartitionNum")
        self.inside = self.owner >= 0                     # still in the record that an earlier range began
        self.fresh = self.start == 0                      # no record of the file has ended yet
        self.held: list[bytes] = []                       # lines since the last end
        self.last: bytes | None = None                    # kept back: the file may end without a separator
        self.head: bytes | None = None
        self.records: list[tuple] = []

    def add(self, lines: list[bytes]) -> None:
        if self.last is not None:
            lines = [self.last, *lines]
        self.last = lines[-1]
        if len(lines) > 1:
            self._cut(lines[:-1])

    def _cut(self, lines: list[bytes]) -> None:
        odd, depth = self.machine.scan(lines)
        odd, per = odd ^ self.odd, depth[int(self.odd)]
        at_end = np.maximum(self.depth + per[:, 0], per[:, 0] - per[:, 1])
        at, ended = 0, [x + self.machine.sep for x in lines]
        for e in np.flatnonzero(~odd & (at_end == 0)).tolist():
            record = b"".join(self.held + ended[at:e + 1])
            if self.inside:
                self.head, self.inside = record, False
            else:
                self.records.append((self.file, self.fresh, record))
            self.held, self.fresh, at = [], False, e + 1
        self.held += ended[at:]
        self.odd, self.depth = bool(odd[-1]), int(at_end[-1])

    def close(self) -> None:
        if self.ended or not self.machine.json:
            self._cut([self.last])
        else:
            self.held.append(self.last)

    def take(self) -> list[tuple]:
        """Whole records so far: ``(file, first of the file, bytes)``."""
        out, self.records = self.records, []
        return out

    def pieces(self) -> list[tuple]:
        """What belongs to records that cross ranges: ``(file, owner, start, first, bytes)``."""
        rest = b"".join(self.held)
        if self.inside:
            return [(self.file, self.owner, self.start, False, rest)]
        out = [] if self.head is None else [(self.file, self.owner, self.start, False, self.head)]
        return out + ([(self.file, self.start, self.start, self.fresh, rest)] if rest else [])


def _cut(machine: Machine, whole: bool):
    """Task function: the records that lie in one range (``whole``), or the pieces of the others."""
    state = [f.split()[0] for f in _STATE.split(", ")]
    types = [pa.int64(), pa.bool_(), pa.binary()] if whole else [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    names = ["file", "first", "v"] if whole else ["file", "owner", "start", "first", "v"]

    def table(rows):
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def run(batches):
        cutter = None

        def over():
            cutter.close()
            return cutter.take() if whole else cutter.pieces()

        for key, lines in _ranges(batches, state):
            if cutter is None or key[:2] != (cutter.file, cutter.start):
                if cutter is not None and (rows := over()):
                    yield table(rows)
                cutter = _Cutter(machine, key)
            cutter.add(lines)
            done = cutter.take()
            if whole and done:
                yield table(done)
        if cutter is not None and (rows := over()):
            yield table(rows)
    return run


def split_records(spark: SparkSession, path: str, machine: Machine) -> DataFrame:
    """``(file, first, v)``: every record's bytes, its end included; ``first`` marks the first one of a file."""
    lines = _lines(spark, path, machine.sep.decode())
    maps = lines.mapInArrow(_mapper(machine), _MAP)
    states = maps.groupBy("file").applyInPandas(_compose, _STATE)
    # One row of about 50 bytes for each range of input: written once, it stays far below the data (and fits a
    # broadcast: a range is 128 MB by default).
    kept = scratch_path(spark, "record-ranges")
    states.write.parquet(kept)
    states = spark.read.schema(_STATE).parquet(kept)
    known = lines.drop("size").join(F.broadcast(states), ["file", "start"], "left")
    inside = known.mapInArrow(_cut(machine, True), "file long, first boolean, v binary")
    pieces = known.mapInArrow(_cut(machine, False), "file long, owner long, start long, first boolean, v binary")
    crossing = (pieces.groupBy("file", "owner")
                .agg(F.array_sort(F.collect_list(F.struct("start", F.col("v").cast("string").alias("t")))).alias("p"), F.max("first").alias("first"))
                .select("file", "first", F.array_join(F.transform("p", lambda x: x["t"]), "").cast("binary").alias("v")))
    return inside.unionByName(crossing)


def read_json_concat(spark: SparkSession, path: str) -> DataFrame:
    """S1 for concatenated objects: ``value``, one JSON object each, whatever stands between or inside them.

    White space between objects is dropped. Anything else outside an object comes as a value of its own, in front
    of the object that follows (parsing rejects it); so does an object that the end of its file cuts off. An
    opening brace that is never closed takes the rest of its file with it.
    """
    records = split_records(spark, path, Machine(json=True))
    text = F.btrim(F.col("v").cast("string"), F.lit(" \t\r\n"))
    at = F.instr(text, "{")
    parts = F.when(at > 1, F.array(F.btrim(F.substr(text, F.lit(1), at - 1), F.lit(" \t\r\n")), F.substr(text, at))).otherwise(F.array(text))
    return records.select(F.explode(F.filter(parts, lambda x: x != "")).alias("value"))


def read_reviews_csv_split(spark: SparkSession, path: str, schema: str | None = None, content_col: str = "content",
                           label_col: str = "recommended") -> DataFrame:
    """Review CSV with line breaks in quoted texts, one file read by many tasks.

    Same rows as ``read_reviews_csv(multi_line=True)``, for files whose quotes stand in quoted fields only, doubled
    inside (RFC 4180): a lone quote inside an unquoted field would shift every record after it. Line breaks inside
    quotes stay as they are (the whole-file reader makes CRLF there LF if the file's lines end in CRLF).
    """
    records = split_records(spark, path, Machine(json=False))
    text = F.regexp_replace(F.col("v").cast("string"), "\r?\n$", "")
    if schema is None:
        names = next(iter(csv.reader([records.where("first").select(text.alias("t")).first()["t"]])))
        row_schema = ", ".join(f"`{n}` STRING" for n in names)
    else:
        row_schema = schema
    options = {"escape": '"', "multiLine": "true"}
    rows = records.where("NOT first").select(text.alias("t")).where("t <> ''")
    out = rows.select(F.from_csv("t", row_schema, options).alias("r")).select("r.*")
    return out if schema else out.select(content_col, label_col)
