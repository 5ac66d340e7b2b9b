"""Column functions for message text.

Every function takes and returns a ``Column`` built from native Spark SQL
expressions, so the whole text path stays inside the JVM (no Python worker) and
Catalyst can prune, push down and codegen around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's behaviour for equal results).
#
# Text normaliser: ordered (regex, output text) steps, then trim and lower-case.
# The output text is what appears in the result; a backslash in it is a literal
# backslash character (the reference emits one before ( ) and ? only).
NORMALIZE_STEPS: list[tuple[str, str]] = [
    (r"[^A-Za-z0-9(),!?'`]", " "),
    (r"'s", " 's"),
    (r"'ve", " 've"),
    (r"n't", " n't"),
    (r"'re", " 're"),
    (r"'d", " 'd"),
    (r"'ll", " 'll"),
    (r",", " , "),
    (r"!", " ! "),
    (r"\(", " \\( "),
    (r"\)", " \\) "),
    (r"\?", " \\? "),
    (r"\s{2,}", " "),
]
# Retweet marker and the number of leading characters it removes.
RT_PREFIX = "RT"
RT_DROP_CHARS = 3
# Sentinel the reference gives to a record without usable text (compat mode only).
NULL_SENTINEL = "null"
# Characters kept by the file-name sanitiser; everything else becomes '_'.
SAFE_NAME_PATTERN = r"[^-_.A-Za-z0-9]"
SAFE_NAME_PREFIX = "stream_"
SAFE_NAME_SUFFIX = ".json"
# Separator of the labelled-text line format "<content>:::<label>", and the text
# written for a missing value in it.
LABELED_SEPARATOR = ":::"
LABELED_NONE = "None"
# ---------------------------------------------------------------------------


def _java_replacement(text: str) -> str:
    """Escape an output text for a Java regex replacement string."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


# On ASCII-only input (after F2) the characters step 1 replaces are a finite set
# (the ASCII characters its pattern matches), so step 1 becomes one ``translate``.
_ASCII_REPLACED = "".join(chr(i) for i in range(128) if re.fullmatch(NORMALIZE_STEPS[0][0], chr(i)))
# Steps 2-12 match literal text: apply them as plain (byte-search) replacements,
# in the same order, instead of running the regex engine.
_LITERAL_STEPS = [(re.sub(r"\\(.)", r"\1", p), out) for p, out in NORMALIZE_STEPS[1:-1]]


def normalize_text(c: ColumnOrName, ascii_input: bool = False) -> Column:
    """F5 + F10 + F9: the reference's cleaner, then trim and lower-case.

    Same thirteen steps in the same order; steps 2-12 run as literal
    ``replace``; with ``ascii_input`` (the text went through ``ascii_strip``)
    step 1 is a ``translate`` of the non-kept ASCII characters to spaces.
    """
    x = _col(c)
    if ascii_input:
        x = F.translate(x, _ASCII_REPLACED, " " * len(_ASCII_REPLACED))
    else:
        x = F.regexp_replace(x, NORMALIZE_STEPS[0][0], " ")
    for literal, output in _LITERAL_STEPS:
        x = F.replace(x, F.lit(literal), F.lit(output))
    x = F.regexp_replace(x, NORMALIZE_STEPS[-1][0], " ")
    return F.lower(F.trim(x))


def normalize_text_stepwise(c: ColumnOrName) -> Column:
    """The same cleaner, one ``regexp_replace`` per fixed step (reference order)."""
    x = _col(c)
    for pattern, output in NORMALIZE_STEPS:
        x = F.regexp_replace(x, pattern, _java_replacement(output))
    return F.lower(F.trim(x))


def clean_text(c: ColumnOrName) -> Column:
    """F2 then F5: ASCII-strip, then normalise (the order the reference uses)."""
    return normalize_text(ascii_strip(c), ascii_input=True)


def ascii_strip(c: ColumnOrName) -> Column:
    """delete (not replace) every non-ASCII character, astral ones included."""
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


def rt_strip(c: ColumnOrName) -> Column:
    """text starting with 'RT' (case-sensitive) loses its first three characters."""
    x = _col(c)
    return F.when(x.startswith(RT_PREFIX), F.substr(x, F.lit(RT_DROP_CHARS + 1))).otherwise(x)


def tokenize(c: ColumnOrName) -> Column:
    """split on single spaces, keeping empty tokens (empty text -> one empty token)."""
    return F.split(_col(c), " ", -1)


def clean_tokens(c: ColumnOrName, ascii_input: bool = False) -> Column:
    """F5 then F6: token array of a text."""
    return tokenize(normalize_text(c, ascii_input=ascii_input))


def clean_text_tokens(c: ColumnOrName) -> Column:
    """token array of a raw text."""
    return tokenize(clean_text(c))


def json_text(c: ColumnOrName, field: str = "text", strict: bool = True, failfast: bool = False) -> Column:
    """the string value of a top-level field of a JSON record.

    A malformed line (anything after the record included), an empty line, a non-object
    record, a missing or null field all give NULL. With ``strict`` (default) a field whose JSON value is not a
    string (a number, an object, ...) also gives NULL, as in the reference, which
    drops such records; the field is parsed into a VARIANT so its JSON type is
    known, and the other fields of the record are skipped, not materialised.
    ``failfast`` (compat, T8): a line that is not JSON at all (empty, broken)
    fails the job, while valid JSON that is not an object with a string field
    (``[1]``, ``"x"``, ``{"delete": {}}``) gives NULL, as in the reference; this
    parses the whole record (``parse_json``), so it is the slower path.
    """
    line = _col(c)
    boxed = F.concat(F.lit("["), line, F.lit("]"))
    if not strict:
        return F.from_json(line, f"`{field}` STRING")[field]
    if failfast:
        parsed = F.parse_json(boxed)
        broken = (F.trim(line) == "") | F.variant_get(parsed, "$[1]", "variant").isNotNull()
        fail = F.when(broken, F.raise_error(F.concat(F.lit("not one JSON value: "), line)).cast("string"))
        value = F.array(F.variant_get(parsed, f"$[0]['{field}']", "variant"))
        text = F.get(F.transform(value, lambda v: F.when(F.schema_of_variant(v) == F.lit("STRING"),
                                                         F.variant_get(v, "$", "string"))), F.lit(0))
        return F.coalesce(fail, text)
    # The boxed line parses only if nothing follows the record; one element only if it is one record.
    records = F.filter(F.array(F.from_json(boxed, f"ARRAY<STRUCT<`{field}`: VARIANT>>")), lambda r: F.size(r) == 1)
    texts = F.transform(records, lambda r: F.when(F.schema_of_variant(r[0][field]) == F.lit("STRING"),
                                                  F.variant_get(r[0][field], "$", "string")))
    return F.when(F.rtrim(line).endswith("}"), F.get(texts, F.lit(0)))


def parsed_record(c: ColumnOrName, field: str = "text") -> Column:
    """One parse of a raw line to a struct ``(text, reason)``; exactly one of both is not NULL.

    ``text`` is that of ``record_text``. Reasons: ``empty`` (nothing but white space), ``malformed`` (not exactly one
    JSON object), ``no_text`` (the field is missing or null), ``text_not_string``.
    """
    line = _col(c)
    boxed = F.concat(F.lit("["), line, F.lit("]"))
    once = F.struct(line.alias("line"), F.from_json(boxed, f"ARRAY<STRUCT<`{field}`: VARIANT>>").alias("records"))

    def judge(x: Column) -> Column:
        one = F.coalesce((F.size(x["records"]) == 1) & F.rtrim(x["line"]).endswith("}"), F.lit(False))
        value = F.get(x["records"], F.lit(0))[field]
        reason = (F.when(F.coalesce(F.trim(x["line"]), F.lit("")) == "", "empty").when(~one, "malformed")
                  .when(value.isNull() | F.is_variant_null(value), "no_text")
                  .when(F.schema_of_variant(value) != F.lit("STRING"), "text_not_string"))
        text = F.when(reason.isNull(), rt_strip(ascii_strip(F.variant_get(value, "$", "string"))))
        return F.struct(text.alias("text"), reason.alias("reason"))

    return F.get(F.transform(F.array(once), judge), F.lit(0))


def json_field(c: ColumnOrName, field: str, ddl_type: str = "STRING") -> Column:
    """F1 for any typed field: ``from_json`` with a one-field schema (pruned parse)."""
    return F.from_json(_col(c), f"`{field}` {ddl_type}")[field]


def record_text(c: ColumnOrName, compat: bool = False) -> Column:
    """F1 -> F2 -> F3 -> F4: a raw JSON line to the message text used downstream.

    Default: NULL when there is no usable text. ``compat``: the reference's
    sentinel text 'null' and fail-fast parsing (T7, T8).
    """
    t = json_text(c, failfast=compat)
    t = rt_strip(ascii_strip(t))
    return F.coalesce(t, F.lit(NULL_SENTINEL)) if compat else t


def emit_if(c: ColumnOrName, pred) -> Column:
    """Generator: one row holding ``c`` when ``pred(c)`` is true, no row otherwise.

    Use it instead of ``select(expr AS x).where(pred(x))`` when ``expr`` is
    costly: Catalyst pushes such a ``where`` below the projection and
    substitutes the alias, so the expression runs twice (in the filter and again
    in the projection). A generator evaluates it once and leaves no filter to push.
    """
    return F.explode(F.filter(F.array(_col(c)), pred))


def emit_row_if(fields: dict[str, Column], pred) -> Column:
    """Generator over one struct (``inline``): its fields become columns, when ``pred`` holds.

    Same purpose as ``emit_if`` for several computed columns at once; filters
    applied later on these columns stop at the generator instead of re-running
    the expressions below it.
    """
    row = F.struct(*[c.alias(n) for n, c in fields.items()])
    return F.inline(F.filter(F.array(row), pred))


def array_input(c: ColumnOrName) -> Column:
    """An array column as generator input that infers no filter.

    For ``explode(col)`` of a plain column Spark infers ``size(col) > 0`` and
    pushes it below the projection that computed ``col``: the expression (e.g.
    the whole text cleaner) would then run twice. Wrapping the column makes the
    input an expression; ``coalesce(col, [])`` explodes to the same rows.
    """
    return F.coalesce(_col(c), F.array().cast("array<string>"))


def emit_text(c: ColumnOrName, compat: bool = False) -> Column:
    """W2 as a generator: the text when it is kept (see ``keep_text``), else no row."""
    if compat:
        return emit_if(c, lambda t: ~t.startswith(NULL_SENTINEL))
    return emit_if(c, lambda t: t.isNotNull())


def emit_nonempty(c: ColumnOrName) -> Column:
    """Generator: the array when it has at least one element, else no row."""
    return emit_if(c, lambda a: F.size(a) > 0)


def keep_text(c: ColumnOrName, compat: bool = False) -> Column:
    """W2 predicate: keep a record's text. Compat also drops text starting 'null' (T7)."""
    x = _col(c)
    return ~x.startswith(NULL_SENTINEL) if compat else x.isNotNull()


def term_list(c: ColumnOrName) -> Column:
    """lower-case, delete spaces, split on ',' and de-duplicate (first seen order)."""
    return F.array_distinct(F.split(F.replace(F.lower(_col(c)), F.lit(" "), F.lit("")), ",", -1))


def normalize_terms(terms: str | Iterable[str]) -> list[str]:
    """Driver-side F11 for a term parameter: same rule as ``term_list``, order kept, nulls dropped."""
    items = terms.lower().replace(" ", "").split(",") if isinstance(terms, str) else [
        t.lower().replace(" ", "") for t in terms if t is not None
    ]
    return list(dict.fromkeys(items))


def normalize_term(c: ColumnOrName) -> Column:
    """F11 for one term of a term table: lower-case, spaces deleted (null stays null)."""
    return F.replace(F.lower(_col(c)), F.lit(" "), F.lit(""))


def safe_name(c: ColumnOrName) -> Column:
    """each character outside [-_.A-Za-z0-9] becomes '_'."""
    return F.regexp_replace(_col(c), SAFE_NAME_PATTERN, "_")


def stream_file_name(c: ColumnOrName) -> Column:
    """the per-term output name 'stream_<safe term>.json'."""
    return F.concat(F.lit(SAFE_NAME_PREFIX), safe_name(c), F.lit(SAFE_NAME_SUFFIX))


def to_json_record(*cols: ColumnOrName, pretty: bool = False) -> Column:
    """encode columns as one JSON object (optionally pretty-printed)."""
    options = {"pretty": "true"} if pretty else {}
    return F.to_json(F.struct(*[_col(c) for c in cols]), options)


def strict_int(c: ColumnOrName) -> Column:
    """F8: integer of a text with optional sign and surrounding whitespace, else NULL.

    Rejects forms a plain cast might accept ('1.0', '1e3', empty); out-of-range
    values give NULL.
    """
    digits = F.regexp_extract(_col(c), r"^\s*([+-]?[0-9]+)\s*$", 1)
    return F.when(digits != "", digits.try_cast("int"))
