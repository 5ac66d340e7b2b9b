"""Near-duplicate groups by b-bit MinHash.

Each text's distinct word shingles give 1024 minima. Bands of whole minima propose candidates; of every
minimum the low two bits are kept and packed, and the similarity of a candidate pair is estimated by
counting equal bit pairs, corrected for chance agreement. Pairs that may reach the threshold are
confirmed on their full shingle sets; groups are the components of confirmed links.

Equal sets are one node. A bucket first proposes a star around
one member. After those links are confirmed and components known, further rounds pair the members of a
bucket that lie outside its largest component with one drawn member of it. What still lies outside is compared
with the members of other components in its buckets, once an exact filter on rare shingles has taken out the
members that can reach nobody there (documents that share a template but little else). A bucket of many sets that
do share rare shingles but stay below the threshold still costs the square of their number.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import Rolling, Runs, _U, lower_ascii, mix64, null_id, odd_numbers, row_keys, scratch, slices, text_bytes, word_bounds
from brandpulse.llm.components import connected_components, merged_components
from brandpulse.llm.repeats import _lists

MINIMA = 1024
BANDS, BAND_ROWS = 32, 4   # a pair at 0.75 shares one of the 32 bands but for a chance of 5e-6
BITS = 2
_LONGS = MINIMA // 64
_ODD = (odd_numbers(MINIMA, 5) >> _U(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, text after text and ascending in each, and how many each text has."""
    data = lower_ascii(data)
    start, end, first = word_bounds(data, off)
    runs = Runs(Rolling(data).of(start, end))
    words = np.diff(first)
    inside = np.zeros(max(len(start) - width + 1, 0), bool)
    text = np.repeat(np.arange(len(words)), words)
    inside[:] = text[:len(inside)] == text[width - 1:width - 1 + len(inside)]
    place = np.flatnonzero(inside)
    short = np.flatnonzero((words > 0) & (words < width))
    hashes = np.concatenate([runs.of(place, place + width), runs.of(first[short], first[short + 1])])
    owner = np.concatenate([text[place], short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(words))


def signatures(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts with shingles: band keys (texts x bands) and packed low bits (texts x 2 planes of longs)."""
    counts = counts[counts > 0]
    at = np.cumsum(counts) - counts
    # The i-th order of shingles: (upper half + i * lower half) * odd number, modulo 2**32.
    x, y = (hashes >> _U(32)).astype(np.uint32), hashes.astype(np.uint32)
    ranked = np.empty_like(x)
    minima = np.empty((MINIMA, len(counts)), np.uint32)
    for i in range(MINIMA if len(counts) else 0):
        x += y
        np.multiply(x, _ODD[i], out=ranked)
        np.minimum.reduceat(ranked, at, out=minima[i])
    wide = minima[:BANDS * BAND_ROWS].astype(np.uint64)
    bands = np.empty((BANDS, len(counts)), np.uint64)
    for j in range(len(bands)):
        key = np.full(len(counts), j + 1, np.uint64)
        for r in range(BAND_ROWS):
            key = mix64(key + wide[j * BAND_ROWS + r] * _U(0x9E3779B97F4A7C15))
        bands[j] = key
    planes = []
    for bit in range(BITS):
        low = ((minima >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8)
        planes.append(np.packbits(np.ascontiguousarray(low.T), axis=1).view(np.uint64))
    return bands.T, np.concatenate(planes, axis=1)


def _scan(width: int):
    def scan(batches):
        for batch in batches:
            for part in slices(batch):
                hashes, counts = shingle_sets(*text_bytes(part.column("_t")), width)
                bands, bits = signatures(hashes, counts)
                full = counts > 0
                node = np.zeros(len(counts), np.uint64)
                if full.any():
                    at = (np.cumsum(counts) - counts)[full]
                    node[full] = mix64(np.add.reduceat(mix64(hashes + _U(0x51ED270B)), at) + counts[full].astype(np.uint64))
                yield pa.record_batch(
                    [part.column("_d"), part.column("_h"), pa.array(counts, pa.int64()),
                     pa.array(node.view(np.int64)), _lists(bands.ravel(), full * bands.shape[1], "u8"),
                     _lists(bits.ravel(), full * bits.shape[1], "u8")], ["_d", "_h", "n", "node", "bands", "bits"])
    return scan


def _sets(width: int):
    def sets(batches):
        for batch in batches:
            for part in slices(batch):
                hashes, counts = shingle_sets(*text_bytes(part.column("_t")), width)
                yield pa.record_batch([part.column("node"), _lists(hashes, counts, "u8")], ["node", "set"])
    return sets


def estimate(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Similarity from packed low bits: equal bit pairs counted, corrected for agreement by chance."""
    same = None
    for i in range(_LONGS):
        equal = F.bitwise_not(a[i].bitwiseXOR(b[i])).bitwiseAND(F.bitwise_not(a[i + _LONGS].bitwiseXOR(b[i + _LONGS])))
        same = F.bit_count(equal) if same is None else same + F.bit_count(equal)
    chance = 2.0 ** -BITS
    return (same / float(MINIMA) - chance) / (1.0 - chance)


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
                  width: int = 5, percent: int = 75, slack: float = 0.075, rounds: int = 1) -> DataFrame:
    """Groups of documents whose shingle sets reach ``percent`` per cent similarity, directly or by a chain.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the distinct ``width``-word shingles
    (a shorter text: its whole word sequence). Returns ``(id_col, _h long: hash of the text, n_shingles long,
    component_id long, kept boolean, _group long)`` with one row per input row: the smallest id of the group, whether
    the row has it, and a number of the group (null for a set of its own without shingles). Pairs whose estimate is below the threshold by ``slack`` (over 4.5 standard
    deviations) are not confirmed.

    Defined cases: a null, empty or blank text has an empty set and is linked with nothing; a null id is the
    smallest id, its component_id null; repeated rows are one group and kept if theirs is the smallest id;
    a very long text is one slice of a map task; an empty table gives no rows; other columns are not read.
    """
    rows = row_keys(docs, id_col, text_col)
    seen = scratch(rows.mapInArrow(
        _scan(width), "_d long, _h long, n long, node long, bands array<long>, bits array<long>"), "minhash-signatures")
    full = seen.where("n > 0")
    low = scratch(full.groupBy("node").agg(F.min(F.struct("_d", "_h")).alias("low")).select("node", "low._d", "low._h"),
                  "minhash-nodes")
    # One row for each distinct set.
    one = full.join(low, ["node", "_d", "_h"]).select("node", "_d", "_h", "n", "bands",
                                                      *[F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(2 * _LONGS)])
    band = one.select("node", F.posexplode("bands").alias("no", "band"))
    # Tables of keys are written before they are joined back: both sides of the join are then plain
    # shuffles, whose skewed partitions can be split (a hot band, node or bucket).
    buckets = scratch(band.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("far"))
                      .where("hub < far").select("band", "hub"), "minhash-buckets")
    member = scratch(band.join(buckets, "band"), "minhash-members")
    bits = [f"b{i}" for i in range(2 * _LONGS)]
    needed = scratch(one.withColumn("short", F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
                     .drop("bands").join(member.select("node").distinct(), "node").dropDuplicates(["node"]),
                     "minhash-needed")
    sets = scratch(rows.join(needed.select("node", "_d", "_h"), ["_d", "_h"]).select("node", "_t")
                   .mapInArrow(_sets(width), "node long, set array<long>").dropDuplicates(["node"]), "minhash-sets")
    side = needed.select("node", "n", *bits)

    def may_link(pairs: DataFrame) -> DataFrame:
        """Pairs of nodes whose sizes and estimate allow the threshold."""
        left = side.select(F.col("node").alias("a"), F.col("n").alias("na"), *[F.col(c).alias(f"a{c}") for c in bits])
        right = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), *[F.col(c).alias(f"b{c}") for c in bits])
        return pairs.join(right, "b").join(left, "a").where(possible()).select("a", "b", "na", "nb")

    def possible() -> Column:
        guess = estimate([F.col(f"a{c}") for c in bits], [F.col(f"b{c}") for c in bits])
        sizes = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        return sizes & (guess >= percent / 100.0 - slack)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets reach the threshold."""
        both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
                .join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a"))
        common = F.size(F.array_intersect("sa", "sb"))
        return both.where(100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b")

    def outside(comps: DataFrame, r: int) -> tuple[DataFrame, DataFrame]:
        """Members of buckets that hold several components, with the bucket's largest; and a member drawn of it."""
        placed = scratch(member.join(comps, "node", "left").select("no", "band", "node", F.coalesce("comp", "node").alias("comp")),
                         "minhash-placed")
        lot = F.struct(F.xxhash64(F.lit(r), "node").alias("lot"), "node")
        split = scratch(placed.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("m"), F.min(lot).alias("lot"))
                        .groupBy("band").agg(F.max(F.struct("m", "comp", "lot")).alias("most"), F.count(F.lit(1)).alias("parts"))
                        .where("parts > 1").select("band", F.col("most.comp").alias("big"), F.col("most.lot.node").alias("draw")),
                        "minhash-split")
        return placed.join(split.select("band", "big"), "band"), split

    star = member.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = scratch(confirmed(may_link(star)), "minhash-star-links")
    comps = connected_components(links, "minhash-star")

    for r in range(rounds):
        placed, split = outside(comps, r)
        drawn = (placed.where("comp <> big").join(split.select("band", "draw"), "band")
                 .select(F.col("draw").alias("a"), F.col("node").alias("b")).distinct())
        more = scratch(confirmed(may_link(drawn)), "minhash-drawn-links")
        if more.isEmpty():
            break
        comps = merged_components(comps, more, "minhash-drawn")

    # What still lies outside meets the other components in its buckets. Of two sets that reach the threshold each
    # has one of the other's rarest shingles among its own rarest: the first n - ceil(n * threshold) + 1 in an order
    # that all sets share, rarest first. So only members stay that share such a shingle with another component of
    # their bucket; template shingles are common and come last.
    placed, _ = outside(comps, rounds)
    mixed = scratch(placed.select("node").distinct(), "minhash-mixed")
    if not mixed.isEmpty():
        item = mixed.join(sets, "node").select("node", F.explode("set").alias("item"))
        often = scratch(item.groupBy("item").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "minhash-often")
        ordered = (item.join(often, "item", "left").groupBy("node")
                   .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("m", F.lit(1)).alias("m"), "item"))).alias("all")))
        first = F.size("all") - F.ceil(F.size("all") * F.lit(percent) / 100.0).cast("int") + 1
        heads = scratch(ordered.select("node", F.explode(F.slice("all", F.lit(1), first)).alias("s")).where("s.m > 1")
                        .select("node", F.col("s.item").alias("item")), "minhash-heads")
        met = placed.select("band", "node", "comp").join(heads, "node")
        apart = scratch(met.groupBy("band", "item").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
                        .select("band", "item"), "minhash-apart")
        live = scratch(met.join(apart, ["band", "item"]).select("band", "node").distinct(), "minhash-live")
        near = scratch(placed.join(live, ["band", "node"]).join(needed.select("node", "n", "short", *bits), "node"), "minhash-near")
        a = near.where("comp <> big").select("band", "no", F.col("short").alias("sa"), F.col("node").alias("a"), F.col("comp").alias("ca"),
                                             F.col("n").alias("na"), *[F.col(c).alias(f"a{c}") for c in bits])
        b = near.select("band", "big", F.col("short").alias("sb"), F.col("node").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"),
                        *[F.col(c).alias(f"b{c}") for c in bits])
        cross = (a.join(b, "band").where((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("big")) | (F.col("a") < F.col("b")))
                                         & possible() & (F.array_position(F.zip_with("sa", "sb", lambda x, y: x == y), True)
                                                         == F.col("no") + 1))
                 .select("a", "b", "na", "nb"))
        more = scratch(confirmed(cross), "minhash-cross-links")
        if not more.isEmpty():
            comps = merged_components(comps, more, "minhash-all")

    named = comps.join(low.select("node", "_d"), "node")
    least = named.groupBy("comp").agg(F.min("_d").alias("least"))
    group = comps.join(least, "comp").select("node", "comp", "least")
    own = scratch(low.select("node", F.col("_d").alias("low")).join(group, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp"), F.coalesce("least", "low").alias("least")), "minhash-groups")
    out = full.select("_d", "_h", "n", "node").join(own, "node").select("_d", "_h", "n", "comp", "least").unionByName(
        seen.where("n = 0").select("_d", "_h", "n", F.lit(None).cast("long").alias("comp"), F.col("_d").alias("least")))
    return out.select(null_id().alias(id_col), "_h", F.col("n").alias("n_shingles"), null_id("least").alias("component_id"),
                      (F.col("_d") == F.col("least")).alias("kept"), F.col("comp").alias("_group"))
