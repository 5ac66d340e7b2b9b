"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted the same fractional number of copies. Whole copies are given
outright; the fractions are rounded in pairs: mass (in words) moves at random from one document of a
pair to the other until one of them is integral. Blocks of documents are rounded side by side, each
leaves one fractional document at most, and those meet in a reduction tree, block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import id_key, null_id, row_keys, scratch

WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 4096      # documents rounded in one group
FAN_IN = 1024          # residual documents that meet in one group of the tree


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """Targets of ``(source, size)`` rows: ``(source, source_size, n_docs, target)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes; no
    target passes ``cap`` times its source's size, and what is cut off is shared by weight among the
    others until none is above. That is the level L with sum(min(cap * size, L * weight)) = sum(size):
    walking the sources by ``size / weight``, L is fixed at the first that is not cut. The windows run
    over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    top = F.col("source_size") * cap
    by_ratio = Window.orderBy(top / F.col("w"), F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = per.select("*", top.alias("top"),
                      (F.sum("source_size").over(everything) - F.sum(top).over(upto) + top).alias("left"),
                      (F.sum("w").over(everything) - F.sum("w").over(upto) + F.col("w")).alias("w_left"))
    step = step.withColumn("level", F.col("left") / F.col("w_left"))
    step = step.withColumn("at", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("top"), F.struct("at", "level"))).over(everything)
    level = first["level"]
    return step.select("source", "source_size", "n_docs",
                       F.least("top", level * F.col("w")).cast("double").alias("target"))


def _unit(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Repeatable numbers in [0, 1) from two long arrays."""
    x = a.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= b.astype(np.int64).view(np.uint64) + np.uint64(salt)
    for shift in (33, 29, 32):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def pivot(size: list[float], part: list[float], draw: list[float]) -> tuple[list[float], int]:
    """Round fractions in order; returns them rounded and the place of the one still open (-1: none).

    ``sum(size * part)`` is kept exactly by every step, and the expected value of each part too.
    """
    part = list(part)
    open_at = -1
    for j, p in enumerate(part):
        if p <= 0.0 or p >= 1.0:
            continue
        if open_at < 0:
            open_at = j
            continue
        i = open_at
        up = min((1.0 - part[i]) * size[i], p * size[j])       # mass that can move from j to i
        down = min(part[i] * size[i], (1.0 - p) * size[j])     # and from i to j
        move = up if draw[j] * (up + down) < down else -down
        part[i] = _snap(part[i] + move / size[i])
        part[j] = _snap(p - move / size[j])
        open_at = next((k for k in (i, j) if 0.0 < part[k] < 1.0), -1)
    return part, open_at


def _snap(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1.0 - 1e-9 else p


def _round_group(rows: pd.DataFrame, salt: int, last: bool) -> pd.DataFrame:
    """One group of one source; large documents first, so that what stays open is small."""
    rows = rows.sort_values(["size", "_d", "_h", "_block"], ascending=[False, True, True, True], kind="stable")
    rows = rows.reset_index(drop=True)
    draw = _unit(rows["_d"].to_numpy(), rows["_h"].to_numpy(), salt) if len(rows) else np.zeros(0)
    part, at = pivot(rows["size"].tolist(), rows["part"].tolist(), draw.tolist())
    if at >= 0 and last:
        again = _unit(rows["_d"].to_numpy()[at:at + 1], rows["_h"].to_numpy()[at:at + 1], salt + 1)[0]
        part[at], at = float(again < part[at]), -1
    rows["part"] = part
    rows["open"] = np.arange(len(rows)) == at
    return rows


def _rounder(salt: int, last: bool):
    return lambda rows: _round_group(rows, salt, last)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, cap: int = 3, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Copies of every document so that each source's words come near its target.

    Returns ``(id_col, _h long, source_col, size long, source_size long, target double, copies long)``,
    one row per input row; ``_h`` is the hash of the text, which names the row together with its id.

    Defined cases: a null or empty text has size 0 and gets no copy; a null source is a source of its
    own, the last; repeated rows are documents of their own; a corpus without words has targets 0; an
    empty table gives no rows. Draws come from id and text, so a rerun on the same rows agrees on any
    cluster. A hot source is many blocks (by hash of the row key), each one group; the groups' open
    documents meet ``FAN_IN`` at a time, whole levels being written to the shared scratch folder.
    """
    size = F.regexp_count(F.col("_t"), F.lit(WORD)).cast("long")
    rows = scratch(row_keys(docs, id_col, text_col, [source_col])
                   .select("_d", "_h", F.col("_c0").alias("source"), size.alias("size")), "mix-sizes")
    targets = source_targets(rows, weights, cap)
    want = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    blocks = F.ceil(F.col("n_docs") / block_rows)
    planned = (
        rows.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("whole", F.when(F.col("size") > 0, F.floor(F.least(want, F.lit(float(cap))))).otherwise(0).cast("long"))
        .withColumn("part", F.when(F.col("size") > 0, F.least(want, F.lit(float(cap))) - F.col("whole")).otherwise(F.lit(0.0)))
        .withColumn("_block", F.pmod(F.xxhash64("_h", "_d"), blocks).cast("long"))
        .select("_d", "_h", "source", "size", "source_size", "target", "whole", "part", "_block")
    )
    most = targets.agg(F.max(blocks)).first()[0] or 1
    levels = 1 + (math.ceil(math.log(most, FAN_IN)) if most > 1 else 0)
    schema = planned.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", open boolean"
    done, todo = [], planned
    for level in range(levels):
        last = level == levels - 1
        out = todo.groupBy("source", "_block").applyInPandas(_rounder(seed + 2 * level, last), schema)
        if last:
            done.append(out)
        else:
            out = scratch(out, f"mix-level{level}")
            done.append(out.where("NOT open"))
            todo = out.where("open").drop("open").withColumn("_block", F.floor(F.col("_block") / FAN_IN).cast("long"))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(null_id().alias(id_col), "_h", F.col("source").alias(source_col), "size", "source_size",
                         "target", (F.col("whole") + F.col("part")).cast("long").alias("copies"))


def apply_mix(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """The documents, each as often as ``mix_sources`` says, with the columns of ``docs``."""
    keys = ["_d", "_h", "_s"]
    plan = (copies.select(id_key(id_col).alias("_d"), "_h", F.xxhash64(F.struct(source_col)).alias("_s"), "copies")
            .groupBy(*keys).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
            .where("_copies > 0"))
    named = docs.select(F.struct("*").alias("_row"), id_key(id_col).alias("_d"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"),
                        F.xxhash64(F.struct(source_col)).alias("_s"))
    # Rows that agree in id, text and source share their copies: the first ones get the remainder.
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy("_copies"))
    own = (F.floor(F.col("_copies") / F.col("_rows"))
           + (F.col("_turn") <= F.col("_copies") % F.col("_rows")).cast("long")).cast("int")
    return (named.join(plan, keys).withColumn("_turn", turn).withColumn("_own", own).where("_own > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_own"))).alias("_i")).select("_row.*"))
