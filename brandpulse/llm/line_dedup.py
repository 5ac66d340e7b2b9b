"""Line dedup with DataFrame functions only: lines are exploded, keyed by two 64-bit hashes of the
normalised line, counted by document, and the lines over the threshold are dropped by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import null_id, row_keys, scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines that at least ``min_docs`` documents share, except in the largest id holding them.

    A line's key is the line without blanks (0x20, 0x09-0x0D) at both ends, A-Z lower-cased; only keys
    of ``min_chars`` code points or more count. Returns ``(id_col, text_col, carry..., n_lines long,
    n_dropped long)`` with one row per input row; ``text_col`` holds the lines that stay, joined by \\n.

    Defined cases: a null or empty text is one empty line and stays empty; a null id sorts below all
    others; each input row is a document of its own when documents are counted, and rows with the same
    id and text share their drops; an empty table gives no rows; other columns are not read.

    Two hash shuffles of 16-byte keys (no text), then one of the documents by row key. A line that a
    third of all rows holds is pre-aggregated before its shuffle; the join back is a plain equi-join,
    whose skewed partitions AQE splits.
    """
    rows = row_keys(docs, id_col, text_col, carry)
    lines = F.split("_t", "\n", -1)
    keys = F.transform(lines, lambda x: F.translate(F.btrim(x, F.lit(BLANKS)), UPPER, UPPER.lower()))
    hashes = F.transform(keys, lambda k: F.when(
        F.char_length(k) >= min_chars,
        F.struct(F.xxhash64(F.lit(1), k).alias("a"), F.xxhash64(F.lit(2), k).alias("b"))))
    # Written before it is joined back: both sides of the join are then plain shuffles, whose skewed
    # partitions can be split (a line that a third of all rows hold).
    common = scratch(
        rows.select("_d", F.explode(F.array_distinct(hashes)).alias("k")).where("k IS NOT NULL")
        .select("_d", F.col("k.a").alias("_a"), F.col("k.b").alias("_b"))
        .groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("_d").alias("_keep"))
        .where(F.col("_n") >= min_docs).select("_a", "_b", "_keep"), "common-lines")
    places = (
        rows.select("_d", "_h", F.posexplode(hashes).alias("_p", "k")).where("k IS NOT NULL")
        .select("_d", "_h", "_p", F.col("k.a").alias("_a"), F.col("k.b").alias("_b"))
    )
    drops = (places.join(common, ["_a", "_b"]).where(F.col("_d") < F.col("_keep"))
             .groupBy("_d", "_h").agg(F.collect_set("_p").alias("_drop")))
    kept = (rows.select("_d", "_h", *[f"_c{i}" for i in range(len(carry))], lines.alias("_lines"))
            .join(drops, ["_d", "_h"], "left")
            .withColumn("_n", F.size("_lines")))
    # _lines is an attribute of the join's output, so the lookup below does not split the text again.
    stay = F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), F.col("_drop"))
    text = F.when(F.col("_drop").isNull(), F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n"))
    return kept.select(null_id().alias(id_col), text.alias(text_col),
                       *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                       F.col("_n").cast("long").alias("n_lines"),
                       F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"))
