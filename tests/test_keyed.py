"""The keyed table: replays, folds by bucket, conflicts, lost folds, flat reads."""

import os

import pytest
from pyspark.sql import functions as F

from brandpulse.session import scratch_path
from brandpulse.sinks.keyed import CommitConflict, KeyedTable

SCHEMA = "k string, v bigint"


def local(path):
    return path.replace("file:", "")


def rows(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA).coalesce(1)


def content(table):
    return dict(map(tuple, table.read().collect()))


def test_latest_and_sum_over_batches_folds_and_replays(spark):
    for how in ("latest", "sum"):
        t = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], SCHEMA, how, buckets=4, fan=2)
        assert content(t) == {}
        want = {}
        for b in range(7):
            pairs = [(f"k{i}", 10 * b + i) for i in range(b % 3, 5)]
            if how == "sum":
                pairs += [("k4", 1)]
            for k, v in pairs:
                want[k] = want.get(k, 0) + v if how == "sum" else v
            t.append(rows(spark, pairs), b)
            t.append(rows(spark, pairs), b)          # the batch is replayed
            assert content(t) == want
            if b % 2:
                t.compact()
                assert content(t) == want
                assert not t.append(rows(spark, [("k0", 999)]), b)   # folded already: a replay changes nothing
                assert content(t) == want
        t.expire(1)
        assert content(t) == want and t.batches() == [6]
        assert [n for n in os.listdir(local(t.root) + "/_manifest") if n.isdigit()] == ["2"]


def test_small_upsert_rewrites_its_buckets_only(spark):
    t = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], SCHEMA, buckets=64, fan=2)
    t.upsert(spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")))
    before = t.compact()
    assert len({r["bucket"] for r in before.runs}) == 64
    n = t.upsert(rows(spark, [("k7", -1), ("k8", -2)]))
    after = t.compact()
    assert n == 1 and after.folded == 1
    gone = [r for r in before.runs if r not in after.runs]
    made = [r for r in after.runs if r not in before.runs]
    assert {r["bucket"] for r in gone} == {r["bucket"] for r in made} and 1 <= len(made) <= 2
    got = content(t)
    assert len(got) == 3000 and got["k7"] == -1 and got["k8"] == -2 and got["k9"] == 9


def test_two_writers_cannot_both_commit(spark, monkeypatch):
    root = scratch_path(spark, "keyed")
    a, b = (KeyedTable(spark, root, ["k"], SCHEMA, buckets=2) for _ in range(2))
    assert a.upsert(rows(spark, [("x", 1)])) == 0
    old = b.manifest()
    a.compact()
    monkeypatch.setattr(b, "manifest", lambda: old)      # b has read the table before a committed
    with pytest.raises(CommitConflict):
        b.compact()
    with pytest.raises(CommitConflict):
        monkeypatch.setattr(b, "batches", lambda: [])
        monkeypatch.setattr(b._store, "names", lambda folder: [])
        b.upsert(rows(spark, [("x", 5)]))                # number 0 is claimed
    assert content(a) == {"x": 1}


def test_a_fold_lost_halfway_loses_nothing(spark, monkeypatch):
    t = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], SCHEMA, "sum", buckets=2, fan=2)
    for b in range(3):
        t.append(rows(spark, [("x", 1), ("y", b)]), b)
    real = t._store.create
    monkeypatch.setattr(t._store, "create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        t.compact()
    monkeypatch.setattr(t._store, "create", real)
    assert content(t) == {"x": 3, "y": 3}
    os.makedirs(local(t.root) + "/updates/batch=3")       # a batch that never finished
    t.compact()
    t.expire(1)
    assert content(t) == {"x": 3, "y": 3} and t.manifest().folded == 2


def test_reads_stay_flat_over_200_batches(spark):
    t = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], SCHEMA, "sum", buckets=1, fan=8)
    logged = spark.range(200).select(F.concat(F.lit("k"), F.col("id") % 5).alias("k"), F.lit(1).cast("bigint").alias("v"),
                                     F.col("id").alias("_seq"), F.col("id").alias("batch"))
    logged.coalesce(1).write.partitionBy("batch").parquet(f"{t.root}/updates")
    most = 0
    for b in range(200):
        open(f"{local(t._folder(b))}/_SUCCESS", "w").close()     # batch b is complete from here on
        if b % 10 == 9:
            t.compact()
            t.expire(1)
            most = max(most, len(t.manifest().runs))
    assert most < 2 * 8 and t.batches() == [] and content(t) == {f"k{i}": 40 for i in range(5)}
