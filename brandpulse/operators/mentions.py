"""Term matching and mention explosion.

A message yields one row per matched term. Three modes:

* ``per_mention`` (default, the reference's written intent): one row per
  matching token, in token order, repeats included;
* ``last_mention`` (the reference as it actually runs, T1): *n* copies of the
  last matching token for *n* matching tokens;
* ``distinct``: one row per distinct matched term.

Matching is on whole, lower-cased tokens. A term list of ordinary size is
inlined as a literal set (Catalyst turns ``IN`` into a hash ``InSet``) and the
explosion is a narrow ``Generate`` fused with the scan: no shuffle at all. For
very large term lists (beyond ``max_inline_terms``) the tokens are matched by an
equi-join against the term table instead, broadcast only when its checked size
is under a bound, otherwise a shuffle join left to AQE's skew handling.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.functions.text import array_input, emit_nonempty, normalize_term

MODES = ("per_mention", "last_mention", "distinct")

# Beyond this many terms the literal set would bloat every task's plan.
DEFAULT_MAX_INLINE_TERMS = 10_000
# Bytes of term text we accept to broadcast (checked, not estimated from stats).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


def match_terms(tokens: Column | str, terms: Iterable[str], lowercase: bool = True) -> Column:
    """W4 (+F9): the tokens that are terms, in order, repeats kept (``hits``)."""
    tok = F.col(tokens) if isinstance(tokens, str) else tokens
    term_list = list(terms)
    if lowercase:
        return F.transform(F.filter(tok, lambda t: F.lower(t).isin(term_list)), lambda t: F.lower(t))
    return F.filter(tok, lambda t: t.isin(term_list))


def mention_array(hits: Column | str, mode: str = "per_mention") -> Column:
    """G1 as an array expression: the terms one message contributes, per mode."""
    _check_mode(mode)
    h = F.col(hits) if isinstance(hits, str) else hits
    if mode == "per_mention":
        return h
    if mode == "distinct":
        return F.array_distinct(h)
    # last_mention: the last hit, repeated once per hit (empty stays empty).
    return F.when(F.size(h) > 0, F.array_repeat(F.try_element_at(h, F.lit(-1)), F.size(h))).otherwise(h)


def explode_mentions(df: DataFrame, tokens_col: str, terms: Iterable[str], mode: str = "per_mention",
                     term_col: str = "term", keep: Iterable[str] | None = None,
                     with_position: bool = False) -> DataFrame:
    """G1: one row per mention, zero rows for a message with none.

    Output: the ``keep`` columns (default: all except ``tokens_col``), then
    ``term_col`` and, with ``with_position``, ``mention_pos`` (0-based rank of
    the mention within its message, making (message, mention_pos) a unique key).
    """
    _check_mode(mode)
    term_list = list(terms)
    keep_cols = list(keep) if keep is not None else [c for c in df.columns if c != tokens_col]
    # Two generators: the first emits the hits once, the second builds the mode's array from that column
    # (which names it several times), so the matching is not evaluated again.
    hits = df.select(*keep_cols, emit_nonempty(match_terms(tokens_col, term_list)).alias("_hits"))
    m = mention_array("_hits", mode)
    if with_position:
        return hits.select(*keep_cols, F.posexplode(m).alias("mention_pos", term_col))
    return hits.select(*keep_cols, F.explode(m).alias(term_col))


def term_table(terms_df: DataFrame, term_col: str) -> DataFrame:
    """F11 for a term table: ``(_term)``, lower-case, spaces deleted, nulls dropped, distinct."""
    return terms_df.select(normalize_term(term_col).alias("_term")).where(F.col("_term").isNotNull()).distinct()


def fits_broadcast(terms: DataFrame, max_bytes: int) -> bool:
    """Whether the measured size of ``(_term)`` is under ``max_bytes`` (not for an empty table)."""
    size = terms.agg(F.sum(F.octet_length("_term") + 16)).first()[0]
    return size is not None and size <= max_bytes


def _checked_broadcast(terms: DataFrame, max_bytes: int) -> DataFrame:
    """Hint a broadcast only if the measured size is under ``max_bytes``."""
    return F.broadcast(terms) if fits_broadcast(terms, max_bytes) else terms


def match_terms_table(df: DataFrame, tokens_col: str, terms_df: DataFrame, term_col: str = "term",
                      max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """W4 for a term *table* of any size: the other columns of ``df`` plus ``hits``.

    ``hits`` is the same array ``match_terms`` gives for the same terms (matching tokens, lower-cased, in token
    order, repeats kept); rows without a hit are dropped. Tokens are exploded under a compact key (two 64-bit
    hashes of the other columns, which must identify a message), matched by an equi-join, gathered by key
    and joined back to the messages: a message's text is never copied to its tokens.
    """
    terms = _checked_broadcast(term_table(terms_df, term_col), max_broadcast_bytes)
    other = [c for c in df.columns if c != tokens_col]
    keyed = df.withColumns({"_k1": F.xxhash64(*other), "_k2": F.xxhash64(F.lit(1), *other)})
    toks = keyed.select("_k1", "_k2", F.posexplode(array_input(tokens_col)).alias("_pos", "_tok")).select(
        "_k1", "_k2", "_pos", F.lower("_tok").alias("_term"))
    gathered = (toks.join(terms, "_term", "inner").groupBy("_k1", "_k2")
                .agg(F.array_sort(F.collect_list(F.struct("_pos", "_term"))).alias("_hits")))
    return keyed.join(gathered, ["_k1", "_k2"]).select(*other, F.transform("_hits", lambda h: h["_term"]).alias("hits"))


def explode_mentions_join(df: DataFrame, tokens_col: str, terms_df: DataFrame, mode: str = "per_mention",
                          term_col: str = "term", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """G1 for a term *table* of any size: tokens are matched by an equi-join.

    The term side is broadcast behind a measured size check; above it the join
    shuffles on the token and AQE splits skewed tokens. The other columns of
    ``df`` must identify a message (carry a key column if texts can repeat).
    Output adds ``term_col`` and ``mention_pos``, a deterministic position that
    makes (message, term, mention_pos) unique: the token position for
    ``per_mention`` and ``distinct`` (first occurrence), the copy number for
    ``last_mention``.
    """
    _check_mode(mode)
    terms = _checked_broadcast(term_table(terms_df, term_col), max_broadcast_bytes)
    other = [c for c in df.columns if c != tokens_col]
    toks = df.select(*other, F.posexplode(array_input(tokens_col)).alias("_pos", "_tok")).select(
        *other, "_pos", F.lower("_tok").alias("_term"))
    hits = toks.join(terms, "_term", "inner")
    if mode == "per_mention":
        return hits.select(*other, F.col("_term").alias(term_col), F.col("_pos").alias("mention_pos"))
    if mode == "distinct":
        return hits.groupBy(*other, F.col("_term").alias(term_col)).agg(F.min("_pos").alias("mention_pos"))
    # last_mention: per message the hit at the highest position, once per hit.
    last = hits.groupBy(*other).agg(F.max_by("_term", "_pos").alias("_last"), F.count("*").alias("_n"))
    return last.select(*other, F.posexplode(F.array_repeat("_last", F.col("_n").cast("int"))).alias("mention_pos", term_col))
