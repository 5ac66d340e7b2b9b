"""Text functions: golden cases of FIXTURES 3.1, 3.2, 3.7 and brute force on real documents."""

import re

import pytest
from pyspark.sql import functions as F

from brandpulse.functions import text as T
from conftest import SF01


def _one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("y")).first()["y"]


def py_normalize(s: str) -> str:
    """Brute force: the thirteen fixed steps with Python's re, one after another."""
    for pattern, output in T.NORMALIZE_STEPS:
        s = re.sub(pattern, lambda _m, o=output: o, s)
    return s.strip().lower()


def py_ascii(s: str) -> str:
    return s.encode("ascii", "ignore").decode("ascii")


CLEAN_CASES = [
    ("It's @Delta!! (really) don't, we've they're I'd we'll?",
     "it 's delta ! ! \\( really \\) do n't , we 've they 're i 'd we 'll \\?", 20),
    ("café @British_Airways  \t x", "caf british airways x", 4),
    ("", "", 1),
    ("   ", "", 1),
    ("naïve IT'S DON'T", "nave it's don't", 3),
    ("😀a'b'sd 's''ve", "a'b 'sd 's' 've", 4),
    ("😀a'b'sd 's''ve `q`", "a'b 'sd 's' 've `q`", 5),
    ("a\\b$1 n't", "a b 1 n't", 4),
]


@pytest.mark.parametrize("raw,clean,n_tokens", CLEAN_CASES)
def test_normalize_golden(spark, raw, clean, n_tokens):
    col = F.col("x")
    assert _one(spark, T.normalize_text(T.ascii_strip(col)), raw) == clean
    assert _one(spark, T.normalize_text_stepwise(T.ascii_strip(col)), raw) == clean
    assert _one(spark, F.size(T.clean_tokens(T.ascii_strip(col))), raw) == n_tokens
    assert py_normalize(py_ascii(raw)) == clean


def test_normalize_passes_equal_steps_on_documents(spark):
    """The five-pass form equals the thirteen-step chain and Python's re on every document."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    # Weave in the characters the documents lack so every step meets input.
    woven = F.replace(F.replace(F.replace(F.col("text"), F.lit("the "), F.lit("the's (")),
                                F.lit("an "), F.lit("an't? ")), F.lit("er"), F.lit("er've'll'd're,!)"))
    rows = docs.select(woven.alias("t")).select(
        "t", T.normalize_text("t").alias("fast"), T.normalize_text_stepwise("t").alias("steps")).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["fast"] == r["steps"]
        assert r["fast"] == py_normalize(r["t"])


def test_ascii_fast_path_equals_steps_on_documents(spark):
    """clean_text (translate on ASCII input) equals ascii_strip + the thirteen regex steps."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("text")
    woven = F.replace(F.replace(F.col("text"), F.lit("the "), F.lit("the's (")), F.lit("on "), F.lit("on'll? "))
    rows = docs.select(woven.alias("t")).select(
        T.clean_text("t").alias("fast"), T.normalize_text_stepwise(T.ascii_strip("t")).alias("steps")).collect()
    assert all(r["fast"] == r["steps"] for r in rows)


def test_ascii_strip_matches_python(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("text")
    for r in docs.select("text", T.ascii_strip("text").alias("a")).collect():
        assert r["a"] == py_ascii(r["text"])


@pytest.mark.parametrize("line,text", [
    ('{"text":"RT @klm: hi"}', "@klm: hi"),
    ('{"text":"RTX y"}', " y"),
    ('{"text":"RT"}', ""),
    ('{"text":"rt x"}', "rt x"),
    ('{"text":"RT\\nx"}', "x"),
    ('{"delete":{}}', None),
    ('{"text":null}', None),
    ("[1]", None),
    ('{"text":123}', None),
    ('{"text":{"a":1}}', None),
    ('{"text":"nullify it"}', "nullify it"),
    ("not json", None),
    ("", None),
    ('{"text":"caf\\u00e9 \\ud83d\\ude00ok"}', "caf ok"),
])
def test_record_text(spark, line, text):
    assert _one(spark, T.record_text(F.col("x")), line) == text


def test_keep_text_compat(spark):
    df = spark.createDataFrame([("nullify it",), (None,), ("ok",)], "x string")
    kept = [r[0] for r in df.select(F.coalesce("x", F.lit("null")).alias("x")).where(T.keep_text("x", compat=True)).collect()]
    assert kept == ["ok"]
    assert sorted(r[0] for r in df.where(T.keep_text("x")).collect()) == ["nullify it", "ok"]


@pytest.mark.parametrize("line", ["not json", ""])
def test_failfast_compat(spark, line):
    df = spark.createDataFrame([(line,)], "x string")
    with pytest.raises(Exception):
        df.select(T.record_text("x", compat=True)).collect()


@pytest.mark.parametrize("line,text", [
    ("[1]", "null"), ('"just a string"', "null"), ('{"delete":{}}', "null"), ('{"text":123}', "null"),
    ('{"text":"RT ok"}', "ok"), ('{"text":"nullify"}', "nullify"),
])
def test_compat_valid_json_without_text(spark, line, text):
    assert _one(spark, T.record_text(F.col("x"), compat=True), line) == text


def test_safe_name(spark):
    assert _one(spark, T.safe_name(F.col("x")), "@Some Air/x#") == "_Some_Air_x_"
    assert _one(spark, T.safe_name(F.col("x")), "a-b_c.9") == "a-b_c.9"
    assert _one(spark, T.stream_file_name(F.col("x")), "@Delta") == "stream__Delta.json"


def test_term_list(spark):
    s = ("americanair, virginamerica, JetBlue, jetblue, British_Airways,westjet")
    got = _one(spark, T.term_list(F.col("x")), s)
    assert got == ["americanair", "virginamerica", "jetblue", "british_airways", "westjet"]
    assert T.normalize_terms(s) == got


def test_strict_int(spark):
    cases = {"1": 1, " 1 ": 1, "+1": 1, "-3": -3, "1.0": None, "None": None, "": None, ":1": None, "9999999999": None}
    for raw, want in cases.items():
        assert _one(spark, T.strict_int(F.col("x")), raw) == want, raw


def test_json_pretty(spark):
    got = _one(spark, T.to_json_record("x", pretty=True), "a")
    assert got.startswith("{\n") and '"x" : "a"' in got


def test_reference_terms_reachability():
    from brandpulse.defaults import REFERENCE_TERMS

    listed = REFERENCE_TERMS.split(",")
    terms = T.normalize_terms(REFERENCE_TERMS)
    assert len(listed) == 29 and len(terms) == 28
    assert len([t for t in terms if "_" not in t]) == 25


def test_cleaning_matches_python_on_random_strings(spark):
    """Property: ascii_strip + normaliser (both forms) equal Python's re steps on random text."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("aAzZ09 \t\n\r\x0b\x0c\x00\x1c\x7f'`(),!?.-_:;\"\\$@#") +
                               ["'s", "'ve", "n't", "'re", "'d", "'ll", "RT", "é", "ß", "😀", " ", " "])
    samples: list[str] = []

    @settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(alphabet, max_size=40).map("".join))
    def collect(s):
        samples.append(s)

    collect()
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    rows = df.select("x", T.clean_text("x").alias("fast"),
                     T.normalize_text_stepwise(T.ascii_strip("x")).alias("steps"),
                     T.normalize_text(T.ascii_strip("x")).alias("general")).collect()
    assert len(rows) == len(samples)
    for r in rows:
        want = py_normalize(py_ascii(r["x"]))
        assert r["fast"] == want, repr(r["x"])
        assert r["steps"] == want, repr(r["x"])
        assert r["general"] == want, repr(r["x"])


def test_record_text_matches_python_on_random_records(spark):
    """Property: JSON line -> text equals Python's json parse, ASCII strip and RT strip."""
    import json as _json

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    texts = st.lists(st.sampled_from(list("RTrt x\n\t\"\\/é😀'") + ["RT ", " ", "\x00"]), max_size=20).map("".join)
    lines: list[tuple[str, str | None]] = []

    @settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
    @given(texts, st.booleans())
    def collect(t, ascii_escape):
        line = _json.dumps({"id": 1, "text": t, "user": {"name": t}}, ensure_ascii=ascii_escape)
        a = py_ascii(t)
        lines.append((line, a[3:] if a.startswith("RT") else a))

    collect()
    df = spark.createDataFrame([(line,) for line, _ in lines], "x string")
    got = [r[0] for r in df.select(T.record_text("x")).collect()]
    assert got == [want for _, want in lines]
