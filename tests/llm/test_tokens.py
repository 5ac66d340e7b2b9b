"""SentencePiece ids and token counts against the library; decoding as an exact round trip."""

import random

import pytest

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from brandpulse.llm.sentencepiece_codec import sentencepiece_decode, sentencepiece_encode  # noqa: E402
from brandpulse.llm.token_counts import token_counts  # noqa: E402

MODEL = P.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(3)
    out = [None, "", " ", "  ", "\n", "a\n\nb", "▁", "a▁b", " ▁▁ x", "日本語テキスト 混在", "<s> </s> <unk> <0x0A>", "x" * 900,
           "ab" * 300, "é" * 250, "    " * 60, "\x00a\x00", "a  b   c    d", " lead", "trail ", "tab\tnew\r\n😀😀 z"]
    letters = list("abcdeth ingo  \n\t.é日▁0123#")
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 500))) for _ in range(80)]
    return out + ["the same text", "the same text"]


def docs(spark):
    rows = [(i if i != 7 else None, t, -1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)


def test_ids_and_round_trip(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = sentencepiece_decode(sentencepiece_encode(docs(spark), MODEL), MODEL)
    got = {(-1 if r.doc_id is None else r.doc_id): (r.ids, r.decoded) for r in out.collect()}
    for i, t in enumerate(texts()):
        ids, decoded = got[-1 if i == 7 else i]
        assert ids == lib.encode(t or ""), t
        assert decoded == (t or "").replace("▁", " ")


@pytest.mark.parametrize("chunk_bytes", [1 << 18, 7])
def test_counts(spark, chunk_bytes):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = token_counts(docs(spark), MODEL, limit=100, chunk_bytes=chunk_bytes).collect()
    got = {(-1 if r.doc_id is None else r.doc_id): tuple(r)[1:] for r in out}
    assert len(out) == len(texts())
    for i, t in enumerate(texts()):
        n = len(lib.encode(t or ""))
        assert got[-1 if i == 7 else i] == (len((t or "").encode()), n, n > 100), t


def test_empty_table(spark):
    empty = docs(spark).limit(0)
    assert token_counts(empty, MODEL).count() == 0
    assert sentencepiece_decode(sentencepiece_encode(empty, MODEL), MODEL).count() == 0


def test_units_that_collide_in_sums_modulo_a_power_of_two(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pattern = [0]
    while len(pattern) < 4096:
        pattern += [1 - x for x in pattern]
    words = ["".join("ab"[x ^ k] for x in pattern[:n]) for n in (1024, 2048, 4096) for k in (0, 1)]
    rows = [(i, w) for i, w in enumerate(words)] + [(99, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.ids for r in sentencepiece_encode(df, MODEL).collect()} == {i: lib.encode(t) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in token_counts(df, MODEL).collect()} == {i: len(lib.encode(t)) for i, t in rows}


def test_long_unbroken_texts(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(8)
    rows = [(0, "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=") for _ in range(300_000))),
            (1, "".join(rng.choice("日本é#xyz{};") for _ in range(150_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.ids for r in sentencepiece_encode(df, MODEL).collect()} == {i: lib.encode(t) for i, t in rows}
