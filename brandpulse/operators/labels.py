"""Labelled review handling.

Reviews arrive as columns (``content``, ``recommended``) or as text lines
``<content>:::<label>``. Everything here is a narrow, per-row transformation:
no shuffle, so these steps fuse into the scan's whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.functions.text import (
    emit_if,
    emit_row_if,
    LABELED_NONE,
    LABELED_SEPARATOR,
    ascii_strip,
    clean_text,
    normalize_text,
    strict_int,
)

TRAIN = "train"
VALID = "valid"


def one_line(c: Column | str) -> Column:
    """A text as one line: every line break becomes one space (the cleaner would do the same)."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"\r\n|\r|\n", " ")


def serialize_labeled(content: Column | str, label: Column | str, compat: bool = False) -> Column:
    """``"<content>:::<label>"`` with a missing value written as ``None``.

    A review is one line: its line breaks become spaces, so no token is lost when the lines are read back.
    ``compat`` leaves them raw, as the reference does; such a review falls into several lines, of which only
    the last carries a label.
    """
    c = F.col(content) if isinstance(content, str) else content
    lab = F.col(label) if isinstance(label, str) else label
    none = F.lit(LABELED_NONE)
    c = F.coalesce(c.cast("string"), none)
    return F.concat_ws(LABELED_SEPARATOR, c if compat else one_line(c), F.coalesce(lab.cast("string"), none))


def parse_labeled(df: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """S3 + F2 + F7 + F5 + F8 + W3: labelled lines to ``(comment STRING, sentiment INT)``.

    The whole line is ASCII-stripped first, split on ':::' with exact arity two,
    the content is normalised and the label must be a strict integer; every other
    line is dropped (content holding ':::' or ending in ':' included, as in the
    reference). ``keep`` columns (e.g. a key) are carried through.
    """
    keep = list(keep or [])
    parts = F.split(ascii_strip(F.col(line_col)), LABELED_SEPARATOR, -1)
    staged = df.select(*keep, emit_if(parts, lambda p: F.size(p) == 2).alias("_parts"))
    fields = {
        "comment": normalize_text(F.col("_parts")[0], ascii_input=True),
        "sentiment": strict_int(F.col("_parts")[1]),
    }
    return staged.select(*keep, emit_row_if(fields, lambda r: r["sentiment"].isNotNull()))


def hash_bucket(key: Column | str, buckets: int = 10) -> Column:
    """Stable bucket of a key: first 32 bits of md5(key as text) mod ``buckets``.

    Unlike ``randomSplit`` it does not depend on partitioning or task retries
    (an executor lost mid-job recomputes the same split), and it is plain SQL.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substr(F.md5(k.cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("bigint"), F.lit(buckets))


def split_column(key: Column | str, train_fraction: float = 0.8) -> Column:
    """R1: 'train' / 'valid' label from the stable hash bucket (80/20 by default)."""
    cut = round(train_fraction * 100)
    return F.when(hash_bucket(key, 100) < cut, F.lit(TRAIN)).otherwise(F.lit(VALID))


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int | None = 42) -> tuple[DataFrame, DataFrame]:
    """R1 as in the reference (``randomSplit``), seeded so it can be repeated."""
    train, valid = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, valid


def label_split(df: DataFrame, key_col: str, content_col: str = "content", label_col: str = "recommended",
                train_fraction: float = 0.8) -> DataFrame:
    """C4 core (P1, R1, W1, P6): the four reference outputs as one tagged DataFrame.

    Rows ``(split, label, sentiment)``; ``label`` is '1' or '0' (string equality,
    other and missing labels fall out as in the reference). One scan and one
    partitioned write replace four cached filters and four single-file saves.
    """
    return (
        df.select(
            F.col(key_col),
            split_column(key_col, train_fraction).alias("split"),
            F.col(label_col).cast("string").alias("label"),
            F.col(content_col).alias("sentiment"),
        )
        .where(F.col("label").isin("1", "0"))
    )


def reviews_to_training(df: DataFrame, content_col: str = "content", label_col: str = "recommended",
                        compat: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Columns to ``(comment STRING, sentiment INT)`` with the reference's rules.

    ``compat`` routes through the text form (serialize then parse), so content
    holding ':::' or ending in ':' is lost exactly as in the reference (T9);
    default keeps such rows and only requires a strict integer label. Missing
    content becomes the text 'None' in both modes.
    """
    keep = list(keep or [])
    if compat:
        lines = df.select(*keep, serialize_labeled(content_col, label_col, compat=True).alias("value"))
        return parse_labeled(lines, keep=keep)
    fields = {
        "comment": clean_text(F.coalesce(F.col(content_col).cast("string"), F.lit(LABELED_NONE))),
        "sentiment": strict_int(ascii_strip(F.col(label_col).cast("string"))),
    }
    # Emitted through a generator: a later filter (e.g. on the split, which is
    # computed from the comment) stops there instead of re-running the cleaner.
    return df.select(*keep, emit_row_if(fields, lambda r: r["sentiment"].isNotNull()))

