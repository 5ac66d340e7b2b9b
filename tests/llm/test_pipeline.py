"""The pipeline: every stage on the predecessor's rows, checked against plain Python."""

import re

import pytest

pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

import corpus_pipeline as C  # noqa: E402
from brandpulse.llm.common import scratch  # noqa: E402
from brandpulse.llm.queries import piece_model  # noqa: E402
from test_minhash import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    before = {r.doc_id: r for r in docs.collect()}
    out = {}
    for name, stage in C.STAGES:
        rows = scratch(stage(spark, docs, SF), "test-stage")
        if name != C.STAGES[-1][0]:
            assert rows.dtypes == docs.dtypes, name
        got = rows.collect()
        if name == "quality_rules":
            assert all(before[r.doc_id] == r for r in got)
            for r in got:
                assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) >= 50
            good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
            lost = [d for d in good & set(before) if d not in {r.doc_id for r in got}
                    and len(re.findall(r"[^\x20\x09-\x0D]+", before[d].text or "")) >= 50]
            assert len(lost) <= 0.1 * len(good)
        if name == "line_dedup":
            seen = {}
            for r in docs.collect():
                for k in {line_key(x) for x in r.text.split("\n")}:
                    seen.setdefault(k, set()).add(r.doc_id)
            want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if not (
                len(line_key(x)) >= 20 and len(seen[line_key(x)]) >= 3 and r.doc_id < max(seen[line_key(x)])))
                for r in docs.collect()}
            assert {r.doc_id: r.text for r in got} == want
            assert all(r.n_chars == len(r.text) for r in got)
        if name == "minhash_dedup":
            want = {d for d, _, _, kept in brute([(r.doc_id, r.text) for r in docs.collect()]) if kept}
            assert sorted(r.doc_id for r in got) == sorted(want)
        if name == "source_mixing":
            size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in docs.collect()}
            sources = sorted({r.source for r in docs.collect()})
            total = sum(size.values())
            own = {s: sum(size[r.doc_id] for r in docs.collect() if r.source == s) for s in sources}
            weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
            target, open_ = {}, set(sources)
            while open_:
                left = total - sum(target.values())
                level = left / sum(weight[s] for s in open_)
                over = {s for s in open_ if level * weight[s] > 3 * own[s]}
                target |= {s: 3 * own[s] for s in over} or {s: level * weight[s] for s in open_}
                open_ = open_ - over if over else set()
            for s in sources:
                taken = sum(size[r.doc_id] for r in got if r.source == s)
                assert abs(taken - target[s]) <= max(size.values()), s
            assert all(sum(x.doc_id == r.doc_id for x in got) <= 3 for r in got)
        if name == "sentencepiece":
            text = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.ids == lib.encode(text[r.doc_id]) and r.decoded == text[r.doc_id] for r in got)
        out[name], docs = len(got), rows
    assert C.run(spark, SF).count() == out["sentencepiece"] > 0


def line_key(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, "word " * 60, "a", 1), (1, "word " * 60, "a", 1), (2, None, None, 2), (None, "", "b", 3),
            (3, " ".join(f"w{i}" for i in range(80)), None, 4), (None, " ".join(f"v{i}" for i in range(70)), "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept int")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    left = C.quality_rules(spark, docs, SF).collect()
    assert {r.doc_id for r in left} <= {3, None} and all(r.text for r in left)
    kept = C.near_dedup(spark, docs, SF).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for i, r in enumerate(docs.collect()) if i != 1)


def test_one_row_of_a_group_stays(spark):
    base = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(base), " ".join(base[:-1] + ["z"]), " ".join(f"v{i}" for i in range(50))
    rows = [(5, text, "a", 1), (5, text, "b", 1), (6, text, "a", 1), (5, near, "a", 1), (None, other, "a", 1), (None, other + " y", "a", 1),
            (7, other, "a", 1), (8, "", "a", 0), (8, "", "a", 0), (None, None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    kept = C.near_dedup(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["5", "8", "8", "None", "None"]
    assert [r.text in (text, near) for r in kept if r.doc_id == 5] == [True]
    assert sum(r.text in (other, other + " y") for r in kept) == 1


def test_sentencepiece_stage_of_odd_rows(spark):
    rows = [(1, "word " * 60, "a", 1), (1, "word " * 60, "a", 1), (2, None, None, 2), (None, "", "b", 3), (3, "x", None, 4), (None, "y", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept int")
    assert C.sentencepiece(spark, docs, SF).count() == 6
