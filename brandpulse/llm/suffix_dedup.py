"""Suffix-array dedup: byte strings of a fixed length that start more than once are cut out.

Suffixes enter at their anchors (see ``repeats``). Sampled splitters range-partition them by their leading
bytes; a bucket orders the suffixes that its packed strings hold by four keys, the hashes of the window's quarters, one
key after the other within equal ones, and neighbours are compared byte by byte. (The order groups equal suffixes; it
is not the order of their bytes.) Ranges are cut between different leads, so equal suffixes share a bucket; exact
copies and classes too large for one bucket are settled by counts of hashes across all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from brandpulse.llm.common import _U, mix64, null_id, row_keys
from brandpulse.llm.repeats import HOT, Scheme, remove_spans, repeated_spans

LENGTH = 400
_CHARACTERS = 4


def multikey_sort(runs, place: np.ndarray, group: np.ndarray, s: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours that agree in all characters: only suffixes tied so far are sorted by the next one."""
    cuts = np.linspace(0, s.window, _CHARACTERS + 1).astype(np.int64)
    active, tied = np.arange(len(place)), group.astype(np.uint64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        if not len(active):
            break
        at = place[active]
        named = mix64(tied * _U(0x9E3779B97F4A7C15) + runs.of(at + a, at + b))
        order = np.argsort(named, kind="stable")
        same = named[order][1:] == named[order][:-1]
        keep = np.append(same, False) | np.append(False, same)
        group_no = np.cumsum(np.append(True, ~same))[keep]
        active, tied = active[order[keep]], group_no.astype(np.uint64)
    joined = np.flatnonzero(tied[1:] == tied[:-1])
    return active[joined], active[joined + 1]


def deal_by_range(packed: DataFrame) -> DataFrame:
    return packed.repartitionByRange("lead", "key").sortWithinPartitions("lead", "key")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
                 length: int = LENGTH, gram: int = 64, hot: int = HOT) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts anywhere else in the corpus.

    Returns ``(id_col, carry..., kept binary, n_units long, n_removed long, removed array<struct<start,end>>)``,
    one row per input row; units are bytes of the UTF-8 text. Strings never cross documents, overlaps count.

    Defined cases: null is an empty text; texts shorter than ``length`` stay; repeated rows repeat each
    other, so they lose all that is long enough; a very long text is one slice of a map task; an empty
    table gives no rows; other columns are not read.
    """
    s = Scheme(window=length, gram=min(gram, length), words=False, step=max(1, length // 24))
    rows = row_keys(docs, id_col, text_col, carry)
    spans = repeated_spans(rows, s, deal_by_range, multikey_sort, "suffix", hot)
    return _named(remove_spans(rows, spans, s), id_col, carry)


def _named(out: DataFrame, id_col: str, carry: Sequence[str]) -> DataFrame:
    from pyspark.sql import functions as F

    return out.select(null_id().alias(id_col), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                      "kept", "n_units", "n_removed", "removed")
