"""Concatenated JSON and CSV with line breaks, cut into many byte ranges, against whole-file readers."""

import csv
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from brandpulse.session import scratch_path
from brandpulse.sources.readers import read_reviews_csv
from brandpulse.sources.records import Machine, read_json_concat, read_reviews_csv_split


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def folder(spark, files):
    path = scratch_path(spark, "rec").replace("file:", "")
    os.makedirs(path)
    for name, data in files.items():
        with open(f"{path}/{name}", "wb") as f:
            f.write(data)
    return path


def test_machine_against_plain_walk():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice('{{}}""\\\\a\n') for _ in range(rng.randint(1, 60)))
        lines = [x.encode() for x in text.split("}")]
        odd, depth = Machine(True).scan(lines)
        for p in (0, 1):
            inside, d, low, slashes, at = bool(p), 0, 0, 0, 0
            for c in text + "}":
                if c == '"' and slashes % 2 == 0:
                    inside = not inside
                slashes = slashes + 1 if c == "\\" else 0
                if not inside and c in "{}":
                    d += 1 if c == "{" else -1
                low = min(low, d)
                if c == "}":
                    assert (inside, d, low) == (bool(odd[at]) ^ bool(p), depth[p, at, 0], depth[p, at, 1])
                    at += 1


def test_json_concat_over_many_ranges(spark, small_ranges):
    rng = random.Random(2)

    def record(i):
        text = "".join(rng.choice(['{', '}', '"', "\\", "\n", "é", "x", " ", "}}", '\\"']) for _ in range(rng.randint(0, 90)))
        return {"id": i, "text": text, "user": {"name": "}", "tags": [{}, {"a": {"b": "{"}}]}}

    files, want = {}, []
    for f, (sep, end) in enumerate([("", ""), ("\n", "\n"), ("\r\n", ""), (" ", "  \n"), ("", "\n")]):
        rows = [json.dumps(record(1000 * f + i), ensure_ascii=i % 2 == 0) for i in range(40)]
        want += rows
        files[f"f{f}.json"] = (sep.join(rows) + end).encode()
    long = json.dumps({"id": 9999, "text": "y" * 3000 + '"{' * 50})       # one record over many ranges
    files["long.json"] = (want[0] + long + want[1]).encode()
    want += [want[0], long, want[1]]
    path = folder(spark, files)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    assert sorted(r["value"] for r in read_json_concat(spark, path).collect()) == sorted(want)


def test_json_concat_odd_files(spark, small_ranges):
    path = folder(spark, {"cut.json": b'{"a":1}{"a":2', "junk.json": b'x {"a":3} ,{"a":4}\n]', "empty.json": b"",
                          "space.json": b" \n ", "deep.json": b'{"a":5}}{"a":6}'})
    got = sorted(r["value"] for r in read_json_concat(spark, path).collect())
    assert got == sorted(['{"a":1}', '{"a":2', "x", '{"a":3}', ",", '{"a":4}', "]", '{"a":5}', "}", '{"a":6}'])


def test_csv_over_many_ranges_equals_multiline(spark, small_ranges):
    rng = random.Random(3)

    def quoted(t):
        return '"' + t.replace('"', '""') + '"' if any(c in t for c in '",\r\n') or rng.random() < 0.3 else t

    files = {}
    for f, end in enumerate(["\n", "\r\n"]):
        rows = []
        for i in range(120):
            text = "".join(rng.choice(["word ", "é", '"', ",", "\n", "\r\n", "\n\n", "x" * 40]) for _ in range(rng.randint(1, 12))).strip(" ")
            rows.append(",".join([str(f * 1000 + i), quoted(text or "none"), rng.choice(["0", "1", ""])]))
        files[f"r{f}.csv"] = (end.join(["id,content,recommended", *rows]) + (end if f else "")).encode()
    path = folder(spark, files)
    schema = "id BIGINT, content STRING, recommended STRING"
    for some in (schema, None):
        got = sorted(map(tuple, read_reviews_csv_split(spark, path, some).collect()), key=str)
        # The whole-file reader turns breaks inside quotes to LF where a file's lines end in CRLF; here they stay.
        lf = lambda rows: sorted((tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in rows), key=str)
        assert lf(got) == lf(read_reviews_csv(spark, path, some).collect()) and len(got) == 240
        plain = []
        for name in files:
            with open(f"{path}/{name}", newline="") as f:
                plain += [(int(r["id"]), r["content"], r["recommended"] or None) if some else (r["content"], r["recommended"] or None)
                          for r in csv.DictReader(f)]
        assert got == sorted(plain, key=str)


def test_changed_ranges_are_noticed(spark, small_ranges):
    path = folder(spark, {"a.json": b'{"a":1}' * 400})
    df = read_json_concat(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    fresh = df.select(F.length("value"))
    with pytest.raises(Exception, match="ranges of the files changed"):
        fresh.collect()


def test_split_scans_are_written_by_as_many_tasks_as_the_input_has(spark, monkeypatch):
    """One task once wrote the whole input of the scans."""
    from pyspark.sql import functions as F

    from brandpulse.plans import extra_queries as Q

    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("a \"}{\"\nline "), "id").alias("text"), F.lit("en").alias("lang")).repartition(4)
    monkeypatch.setattr(Q, "_docs", lambda *a: docs)
    monkeypatch.setattr(Q, "_reviews", lambda *a: docs.select("doc_id", F.col("text").alias("content"), F.lit("1").alias("recommended")))
    paths = []
    monkeypatch.setattr(Q, "scratch_path", lambda s, n, f=Q.scratch_path: paths.append(f(s, n)) or paths[-1])
    want = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted((r[0], r[1]) for r in Q.q_csv_split_scan(spark, "").collect()) == want
    assert sorted((r[0], r[1]) for r in Q.q_json_concat_scan(spark, "").collect()) == want
    for path in paths:
        assert spark.read.text(path).select(F.input_file_name()).distinct().count() == 4
