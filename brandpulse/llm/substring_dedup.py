"""Substring dedup by super-k-mer partitioning.

Consecutive windows of words that share a minimiser travel as one packed string to the minimiser's bucket;
there all windows are sorted, which counts them exactly (see ``repeats`` for the steps around it).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from brandpulse.llm.common import _U, mix64, row_keys
from brandpulse.llm.repeats import HOT, Scheme, remove_spans, repeated_spans
from brandpulse.llm.suffix_dedup import _named

WORDS = 35


def sort_windows(runs, place: np.ndarray, group: np.ndarray, s: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of the sorted windows that agree in group and hash."""
    named = mix64(group.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + runs.of(place, place + s.window))
    order = np.argsort(named, kind="stable")
    same = np.flatnonzero(named[order][1:] == named[order][:-1])
    return order[same], order[same + 1]


def deal_by_minimiser(packed: DataFrame) -> DataFrame:
    return packed.repartition("key").sortWithinPartitions("key")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
                    window: int = WORDS, gram: int = 8, hot: int = HOT) -> DataFrame:
    """Remove each word covered by ``window`` consecutive words that also start anywhere else in the corpus.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Returns ``(id_col, carry..., kept binary: the kept words
    joined by one space, n_units long: words, n_removed long, removed array<struct<start,end>>)``, one row
    per input row. Windows never cross documents and are judged on the input.

    Defined cases: null and empty texts have no words; texts with fewer words than ``window`` stay; repeated
    rows repeat each other; a very long text is one slice of a map task; an empty table gives no rows;
    other columns are not read.
    """
    s = Scheme(window=window, gram=min(gram, window), words=True, step=max(1, window // 12))
    rows = row_keys(docs, id_col, text_col, carry)
    spans = repeated_spans(rows, s, deal_by_minimiser, sort_windows, "substring", hot)
    return _named(remove_spans(rows, spans, s), id_col, carry)
