"""DuckDB SQL fragments used by the oracle queries (independent of the Spark code path).

The oracle normaliser is the thirteen-step chain, one ``regexp_replace`` per
fixed step; the Spark side uses the five-pass form. Equal results therefore
also check that the two forms agree.
"""

from __future__ import annotations

# FIXED VALUES: the cleaner's steps stated anew for the oracle, so a wrong step on the Spark side shows.
_STEPS = [
    ("[^A-Za-z0-9(),!?'`]", " "), ("'s", " 's"), ("'ve", " 've"), ("n't", " n't"), ("'re", " 're"), ("'d", " 'd"),
    ("'ll", " 'll"), (",", " , "), ("!", " ! "), (r"\(", r" \( "), (r"\)", r" \) "), (r"\?", r" \? "), (r"\s{2,}", " "),
]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ascii_sql(e: str) -> str:
    return f"regexp_replace({e}, '[^\\x00-\\x7F]', '', 'g')"


def rt_sql(e: str) -> str:
    return f"(CASE WHEN starts_with({e}, 'RT') THEN substr({e}, 4) ELSE {e} END)"


def normalize_sql(e: str) -> str:
    x = e
    for pattern, output in _STEPS:
        rewrite = output.replace("\\", "\\\\")
        x = f"regexp_replace({x}, {q(pattern)}, {q(rewrite)}, 'g')"
    return f"lower(trim({x}))"


def tokens_sql(e: str) -> str:
    return f"string_split({normalize_sql(ascii_sql(e))}, ' ')"


def in_list(terms: list[str]) -> str:
    return "(" + ", ".join(q(t) for t in terms) + ")"


def hits_sql(tokens: str, terms: list[str]) -> str:
    return f"list_filter({tokens}, lambda x: x IN {in_list(terms)})"


def mode_sql(h: str, mode: str) -> str:
    if mode == "per_mention":
        return h
    if mode == "distinct":
        return f"list_distinct({h})"
    return f"list_transform({h}, lambda x: {h}[-1])"


def split_sql(key: str, train_pct: int = 80) -> str:
    bucket = f"((('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::UBIGINT) % 100)"
    return f"(CASE WHEN {bucket} < {train_pct} THEN 'train' ELSE 'valid' END)"


def strict_int_sql(e: str) -> str:
    return (f"(CASE WHEN regexp_matches({e}, '^\\s*[+-]?[0-9]+\\s*$') "
            f"THEN TRY_CAST(trim({e}, ' \t\n\r\x0b\x0c') AS INTEGER) END)")
