"""Windows of fixed length that occur more than once in a corpus, exactly and without shipping every window.

Shared by suffix-array dedup (units are bytes) and substring dedup (units are words).

A text's windows are cut into segments: runs of consecutive windows with the same anchor, the leftmost
least-hashed gram inside the window. Equal windows have equal anchors at equal offsets, so windows need
comparing only among segments of one anchor. Steps, all Spark jobs:

1. map: every text yields its segments as (anchor key, digest of the whole segment, first window, windows);
2. anchors that occur once drop out; where all segments of an anchor agree, all of their windows repeat;
3. of the others, segments that occur twice or more repeat as a whole, and one representative of every
   distinct segment travels as one packed string to its bucket, where its windows are sorted and compared;
4. anchors with more than ``hot`` distinct segments would make a bucket too large. Their segments are cut by
   window offset into short blocks, counted by block and then by single window, in plain pre-aggregated
   counts: exact again, and no group of rows meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import _U, Runs, byte_table, mix64, scratch, slices, text_bytes, word_bounds

HOT = 512
BUCKET_BYTES = 1 << 20     # packed strings compared at once (a group of one anchor stays together)


@dataclass(frozen=True)
class Scheme:
    """window and gram in units; ``words``: units are words, else bytes."""

    window: int
    gram: int
    words: bool
    step: int              # windows of a block of a hot anchor

    def units(self, data: np.ndarray, off: np.ndarray):
        """``(value, start, end, first)`` of every unit; byte bounds, first unit of each text."""
        if not self.words:
            at = np.arange(len(data), dtype=np.int64)
            return byte_table()[data], at, at + 1, off
        start, end, first = word_bounds(data, off)
        return Runs(byte_table()[data]).of(start, end), start, end, first


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value (by its upper half) in every run of ``width`` values."""
    n = len(values)
    ranked = (values & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    table = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    table[:n] = ranked
    table = table.reshape(rows, width)
    ahead = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    back = np.minimum.accumulate(table, axis=1).ravel()
    m = n - width + 1
    return (np.minimum(ahead[:m], back[width - 1:width - 1 + m]) & _U(0xFFFFFFFF)).astype(np.int64)


def segments(values: np.ndarray, first: np.ndarray, s: Scheme):
    """``(text, start, count, key, digest, anchor)``; start and anchor count units in the whole array."""
    empty = np.zeros(0, np.int64)
    if len(values) < s.window:
        return empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, np.uint64), empty
    runs = Runs(values)
    grams = runs.fixed(s.gram)
    anchor = sliding_least(grams, s.window - s.gram + 1)
    n = len(values) - s.window + 1
    room = np.zeros(n + 1, np.int8)       # windows inside one text
    last = first[1:] - s.window + 1
    fits = last > first[:-1]
    np.add.at(room, first[:-1][fits], 1)
    np.add.at(room, last[fits], -1)
    valid = np.cumsum(room[:n], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    inner = first[(first > 0) & (first < n)]
    new[inner] |= valid[inner]
    start = np.flatnonzero(new)
    stop = np.append(start[1:], n)
    # A segment also stops where valid windows stop: windows left in its text.
    text = np.searchsorted(first, start, side="right") - 1
    stop = np.minimum(stop, first[text + 1] - s.window + 1)
    return text, start, stop - start, grams[anchor[start]], runs.of(start, stop - 1 + s.window), anchor[start]


def _lists(values, counts, kind) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if kind == "u8" else values))


def _scanner(s: Scheme):
    def scan(batches):
        for batch in batches:
            for part in slices(batch):
                data, off = text_bytes(part.column("_t"))
                values, _, _, first = s.units(data, off)
                text, start, count, key, digest, _ = segments(values, first, s)
                per = np.bincount(text, minlength=part.num_rows)
                yield pa.record_batch(
                    [part.column("_d"), part.column("_h"),
                     _lists((start - first[text]).astype(np.int32), per, "i4"), _lists(count.astype(np.int32), per, "i4"),
                     _lists(key, per, "u8"), _lists(digest, per, "u8")], ["_d", "_h", "start", "count", "key", "digest"])
    return scan


_BODY = ("key long, digest long, n long, _d long, _h long, start int, count int, hot boolean, lead long, "
         "offset int, body binary, windows array<long>")


def _packer(s: Scheme):
    """Representatives of a text as packed strings, or as blocks of window digests for hot anchors."""
    def pack(batches):
        for batch in batches:
            for part in slices(batch):
                yield from _pack(part, s)
    return pack


def _pack(part, s: Scheme):
    data, off = text_bytes(part.column("_t"))
    values, begin, end, first = s.units(data, off)
    runs = Runs(values)
    grams = runs.fixed(s.gram)
    wanted = part.column("want")
    flat = wanted.flatten()
    field = {f.name: flat[i].to_numpy(zero_copy_only=False) for i, f in enumerate(_struct(wanted.values.type))} \
        if isinstance(flat, list) else {f.name: flat.field(f.name).to_numpy(zero_copy_only=False)
                                        for f in _struct(flat.type)}
    lengths = np.diff(wanted.offsets.to_numpy())
    text = np.repeat(np.arange(part.num_rows), lengths)
    ids, hashes = part.column("_d").to_numpy(), part.column("_h").to_numpy()
    start = field["start"].astype(np.int64) + first[text]
    count, hot = field["count"].astype(np.int64), field["hot"].astype(bool)
    rows: dict[str, list] = {k: [] for k in ("key", "digest", "n", "_d", "_h", "start", "count", "hot", "lead",
                                             "offset", "body", "windows")}

    def put(**kw):
        for k, v in kw.items():
            rows[k].append(v)

    key = field["key"].astype(np.int64).view(np.uint64)
    for i in range(len(text)):
        a, c, t = int(start[i]), int(count[i]), int(text[i])
        # The anchor: the one gram of the first window with the segment's key (leftmost).
        anchor = a + int(np.argmax(grams[a:a + s.window - s.gram + 1] == key[i]))
        who = {"_d": ids[t], "_h": hashes[t], "n": field["n"][i]}
        if not hot[i]:
            if s.words:
                body = b" ".join(data[begin[j]:end[j]].tobytes() for j in range(a, a + c - 1 + s.window))
            else:
                body = data[a:a + c - 1 + s.window].tobytes()
            lead = int.from_bytes(data[begin[anchor]:begin[anchor] + 8].tobytes().ljust(8, b"\0"), "big") - 2 ** 63
            put(key=field["key"][i], digest=field["digest"][i], start=a - first[t], count=c, hot=False, lead=lead,
                offset=anchor - a, body=body, windows=None, **who)
            continue
        places = np.arange(a, a + c)
        whole = runs.of(places, places + s.window).view(np.int64)
        block = (anchor - places) // s.step
        cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        for b, e in zip(cuts, np.append(cuts[1:], c)):
            d, p, q = int(block[b]), a + int(b), a + int(e)
            core = runs.of(np.array([anchor - d * s.step]), np.array([anchor - (d + 1) * s.step + 1 + s.window]))
            own = runs.of(np.array([p]), np.array([q - 1 + s.window]))
            put(key=int(mix64(core + key[i] * _U(3) + _U(d)).view(np.int64)[0]),
                digest=int(mix64(own + _U(anchor - p)).view(np.int64)[0]), start=p - first[t], count=q - p, hot=True,
                lead=0, offset=0, body=None, windows=whole[b:e].tolist(), **who)
    if rows["key"]:
        kinds = {"key": pa.int64(), "digest": pa.int64(), "n": pa.int64(), "_d": pa.int64(), "_h": pa.int64(),
                 "start": pa.int32(), "count": pa.int32(), "hot": pa.bool_(), "lead": pa.int64(), "offset": pa.int32(),
                 "body": pa.binary(), "windows": pa.list_(pa.int64())}
        yield pa.record_batch([pa.array(rows[k], kinds[k]) for k in kinds], list(kinds))


def _struct(kind):
    return [kind.field(i) for i in range(kind.num_fields)]


def equal_ranges(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``data[a:a+length] == data[b:b+length]``, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", buffer=padded.tobytes(), strides=(1,))
    same = np.ones(len(a), bool)
    for j in range(0, int(length.max(initial=0)), 8):
        left = length - j
        x = words[np.minimum(a + j, len(data))] ^ words[np.minimum(b + j, len(data))]
        short = np.clip(8 - left, 0, 7).astype(np.uint64) * _U(8)
        same &= (left <= 0) | ((x << short) == 0)
    return same


def repeated_in_bucket(bodies: list[bytes], group: np.ndarray, offset: np.ndarray, count: np.ndarray, s: Scheme,
                       sort: Callable) -> tuple[np.ndarray, np.ndarray]:
    """``(body number, window)`` flags: which windows of the packed strings occur twice or more.

    Windows can only be equal within a group and at the same distance from the anchor. ``sort`` orders
    them and gives neighbours that look equal; equality is then confirmed byte by byte.
    """
    data = np.frombuffer(b"".join(bodies), np.uint8)
    off = np.zeros(len(bodies) + 1, np.int64)
    np.cumsum([len(b) for b in bodies], out=off[1:])
    values, begin, end, first = s.units(data, off)
    owner = np.repeat(np.arange(len(bodies)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    place = first[owner] + within
    distance = offset[owner] - within
    a, b = sort(Runs(values), place, group[owner] * (s.window + 1) + distance, s)
    from_a, from_b = begin[place[a]], begin[place[b]]
    long_a, long_b = (end[place[x] + s.window - 1] - begin[place[x]] for x in (a, b))
    same = (long_a == long_b) & equal_ranges(data, from_a, from_b, np.minimum(long_a, long_b))
    hit = np.zeros(len(owner), bool)
    hit[a[same]] = True
    hit[b[same]] = True
    if not same.all():   # neighbours with equal hashes and unequal bytes: settle their classes by the bytes themselves
        seen: dict = {}
        for i in np.unique(np.concatenate([a, b])):
            seen.setdefault((group[owner[i]], data[begin[place[i]]:end[place[i] + s.window - 1]].tobytes()), []).append(i)
        for members in seen.values():
            if len(members) > 1:
                hit[members] = True
    return owner, hit


def _comparer(s: Scheme, sort: Callable):
    """Streams one bucket, sorted by key; a group that crosses a batch boundary is carried over and compared whole."""
    names = ["key", "n", "_d", "_h", "start", "count", "offset", "body"]

    def compare(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).select(names)
                held.append(part)
                size += part.nbytes
                if size >= 2 * BUCKET_BYTES:
                    rows = pa.Table.from_batches(held)
                    keys = rows["key"].to_numpy()
                    cut = int(np.flatnonzero(keys != keys[-1]).max(initial=-1)) + 1
                    if cut:
                        yield from _compare(rows.slice(0, cut), s, sort)
                    held = rows.slice(cut).combine_chunks().to_batches()
                    size = sum(x.nbytes for x in held)
        if held:
            yield from _compare(pa.Table.from_batches(held), s, sort)
    return compare


def _compare(rows, s: Scheme, sort: Callable):
    if not rows.num_rows:
        return
    keys = rows["key"].to_numpy()
    _, group = np.unique(keys, return_inverse=True)
    count = rows["count"].to_numpy().astype(np.int64)
    owner, hit = repeated_in_bucket(rows["body"].to_pylist(), group, rows["offset"].to_numpy().astype(np.int64), count,
                                    s, sort)
    hit &= (rows["n"].to_numpy() == 1)[owner]      # the others repeat as a whole anyway
    at = np.flatnonzero(hit)
    if not len(at):
        return
    new = np.append(True, (np.diff(at) > 1) | (np.diff(owner[at]) > 0))
    begin = at[new]
    last = at[np.append(new[1:], True)]
    within = begin - (np.cumsum(count) - count)[owner[begin]]
    who = owner[begin]
    yield pa.record_batch(
        [pa.array(rows["_d"].to_numpy()[who]), pa.array(rows["_h"].to_numpy()[who]),
         pa.array((rows["start"].to_numpy()[who] + within).astype(np.int32)),
         pa.array((last - begin + 1).astype(np.int32))], ["_d", "_h", "start", "count"])


def _agreement(rows: DataFrame) -> DataFrame:
    """``(key, mixed)`` for keys that occur twice or more: whether their digests differ."""
    return (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
            .where("n >= 2").select("key", (F.col("lo") != F.col("hi")).alias("mixed")))


_SPAN = "_d long, _h long, start int, count int"


def repeated_spans(rows: DataFrame, s: Scheme, deal: Callable[[DataFrame], DataFrame], sort: Callable,
                   name: str, hot: int = HOT) -> DataFrame:
    """Runs of windows that occur twice or more: ``(_d, _h, start, count)`` in units, for rows of ``row_keys``.

    ``deal`` sends packed strings to buckets (all of one key to one), ``sort`` orders windows in a bucket.
    """
    span = ["_d", "_h", "start", "count"]
    found = rows.select("_d", "_h", "_t").mapInArrow(
        _scanner(s), "_d long, _h long, start array<int>, count array<int>, key array<long>, digest array<long>")
    found = scratch(found, f"{name}-segments")
    occ = found.select("_d", "_h", F.inline(F.arrays_zip("start", "count", "key", "digest")))
    # Tables of keys are written before they are joined back: both sides of the join are then plain
    # shuffles, whose skewed partitions can be split (an anchor that a third of all texts hold).
    stat = scratch(_agreement(occ), f"{name}-anchors")
    often = scratch(occ.join(stat, "key"), f"{name}-often")
    pure = often.where("NOT mixed").select(*span)
    mixed = often.where("mixed")
    per = (mixed.groupBy("key", "digest")
           .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*span)).alias("rep")))
    per = scratch(per.select("key", "digest", "n", "rep.*"), f"{name}-distinct")
    large = scratch(per.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot)
                    .select("key", F.lit(True).alias("hot")), f"{name}-hot")
    reps = per.join(large, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    whole = mixed.join(per.where("n >= 2").select("key", "digest"), ["key", "digest"]).select(*span)

    want = reps.groupBy("_d", "_h").agg(
        F.collect_list(F.struct("key", "digest", "n", "start", "count", "hot")).alias("want"))
    packed = scratch(rows.select("_d", "_h", "_t").join(want, ["_d", "_h"]).mapInArrow(_packer(s), _BODY), f"{name}-packed")
    compared = deal(packed.where("NOT hot")).mapInArrow(_comparer(s, sort), _SPAN)

    blocks = packed.where("hot").select("key", "digest", "_d", "_h", "start", "count", "windows")
    twice = blocks.join(scratch(_agreement(blocks), f"{name}-blocks"), "key")
    single = twice.where("mixed").select("key", "_d", "_h", F.col("start").alias("at"), F.posexplode("windows").alias("i", "w"))
    dup = scratch(single.groupBy("key", "w").agg(F.count(F.lit(1)).alias("m")).where("m >= 2").select("key", "w"),
                  f"{name}-singles")
    singles = single.join(dup, ["key", "w"]).select("_d", "_h", (F.col("at") + F.col("i")).alias("start"), F.lit(1).alias("count"))
    spans = pure
    for more in (whole, compared, twice.where("NOT mixed").select(*span), singles):
        spans = spans.unionByName(more)
    return spans


def remove_spans(rows: DataFrame, spans: DataFrame, s: Scheme) -> DataFrame:
    """Cut the windows of ``spans`` out of the texts: row keys, carried columns, ``kept binary, n_units, n_removed,
    removed array<struct<start int, end int>>`` (maximal runs of units)."""
    per = spans.groupBy("_d", "_h").agg(F.collect_set(F.struct("start", "count")).alias("_s"))
    joined = rows.join(per, ["_d", "_h"], "left")
    carried = [c for c in rows.columns if c != "_t"]

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                yield _cut(part, s, carried)

    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {fields[c]}" for c in carried)
    return joined.mapInArrow(cut, schema + ", kept binary, n_units long, n_removed long, removed array<struct<start:int,end:int>>")


def _cut(part, s: Scheme, carried):
    data, off = text_bytes(part.column("_t"))
    _, begin, end, first = s.units(data, off)
    mark = np.zeros(int(first[-1]) + 1, np.int64)
    spans = part.column("_s")
    for t, one in enumerate(spans):
        if one.is_valid:
            inner = one.values
            a = inner.field("start").to_numpy().astype(np.int64) + first[t]
            np.add.at(mark, a, 1)
            np.add.at(mark, a + inner.field("count").to_numpy() - 1 + s.window, -1)
    gone = np.cumsum(mark[:-1]) > 0
    kept, removed, n_removed = [], [], []
    for t in range(part.num_rows):
        a, b = int(first[t]), int(first[t + 1])
        g = gone[a:b]
        if s.words:
            stay = np.flatnonzero(~g) + a
            raw = data[off[t]:off[t + 1]].tobytes()
            kept.append(b" ".join(raw[x:y] for x, y in zip((begin[stay] - off[t]).tolist(), (end[stay] - off[t]).tolist())))
        else:
            kept.append(data[a:b][~g].tobytes())
        edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
        removed.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
        n_removed.append(int(g.sum()))
    return pa.record_batch(
        [*[part.column(c) for c in carried], pa.array(kept, pa.binary()), pa.array(np.diff(first), pa.int64()),
         pa.array(n_removed, pa.int64()),
         pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
        [*carried, "kept", "n_units", "n_removed", "removed"])
