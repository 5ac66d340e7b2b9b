"""A keyed table on files: a log of batches, runs of hash buckets, and a manifest.

Layout under the root::

    updates/batch=<id>/      what one batch changes, written as a whole; a replayed batch replaces its own folder
    runs/<name>/_bucket=<b>/ folded rows of one bucket
    _manifest/<version>      one JSON document: which runs hold which bucket, and up to which batch the log is folded

Readers take the newest manifest's runs and the batches after its mark and reduce them by key, either to the
row of the highest batch (``latest``) or to sums (``sum``). Both reductions give the same result in any order
and grouping, so folding never changes what is read.

Folding is levelled and by bucket. The batches since the mark become one run of level 1 that has only the
buckets they touch; a bucket that has gathered ``fan`` runs of one level gets one run of the next level instead.
So a small batch rewrites the buckets it touches, a row is rewritten once a level, and the runs of a bucket grow
with the logarithm of the batches.

A fold counts once its manifest is there. It is written aside and renamed to the next version without
replacing: of two writers one succeeds, the other raises ``CommitConflict`` and has changed nothing. A fold lost
halfway leaves files that no manifest names. (A rename that does not replace is atomic on HDFS-like stores;
elsewhere let one writer fold.)
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.operators.upsert import latest_per_key

SEQ = "_seq"        # the batch a row comes from
BUCKET = "_bucket"


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


class Store:
    """The few file operations of the table, on whatever file system the path names (Hadoop's API)."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self.path(root).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self.path(name)))

    def batches(self, folder: str) -> list[int]:
        """Numbers of the complete ``batch=<id>`` folders in ``folder``."""
        names = [n for n in self.names(folder) if n.startswith("batch=") and n[6:].isdigit()]
        return sorted(int(n[6:]) for n in names if self.exists(f"{folder}/{n}/_SUCCESS"))

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a whole file beside and rename it; ``CommitConflict`` if the name is taken."""
        aside = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        # FileContext's rename without options fails where the target exists.
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(option.NONE.getClass(), 1)
        options[0] = option.NONE
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(self.path(name)), options)
        except Exception as e:
            self._fs.delete(aside, False)
            if self.exists(name):
                raise CommitConflict(name) from None
            raise e

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


@dataclass
class Manifest:
    version: int = -1
    folded: int = -1                                      # every batch up to this one is in the runs
    runs: list[dict] = field(default_factory=list)        # {"bucket", "level", "path"}

    def dump(self) -> str:
        return json.dumps({"folded": self.folded, "runs": self.runs})


class KeyedTable:
    """See the module text. ``schema`` is the DDL of all columns; ``keys`` name a row; ``how`` is ``latest`` or ``sum``."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema: str, how: str = "latest",
                 buckets: int = 64, fan: int = 8):
        if how not in ("latest", "sum"):
            raise ValueError(f"how must be 'latest' or 'sum', not {how!r}")
        self.spark, self.root, self.keys, self.how = spark, root.rstrip("/"), list(keys), how
        self.buckets, self.fan = buckets, fan
        empty = spark.createDataFrame([], schema)
        self.columns, self.values = empty.columns, [c for c in empty.columns if c not in self.keys]
        self._stored = empty.withColumn(SEQ, F.lit(0).cast("long")).schema
        self._store = Store(spark, self.root)

    # -- reading

    def manifest(self) -> Manifest:
        versions = [int(n) for n in self._store.names(f"{self.root}/_manifest") if n.isdigit()]
        if not versions:
            return Manifest()
        body = json.loads(self._store.read(f"{self.root}/_manifest/{max(versions)}"))
        return Manifest(max(versions), body["folded"], body["runs"])

    def batches(self) -> list[int]:
        """Batches of the log whose folder is complete."""
        return self._store.batches(f"{self.root}/updates")

    def _folder(self, batch: int) -> str:
        return f"{self.root}/updates/batch={batch}"

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*[f"{self.root}/{p}" for p in paths])

    def _merge(self, rows: DataFrame) -> DataFrame:
        """One row a key with its batch."""
        if self.how == "sum":
            return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.values], F.max(SEQ).alias(SEQ))
        return latest_per_key(rows.withColumn("_order", F.col(SEQ)), self.keys, ["_order"]).drop("_order")

    def read(self) -> DataFrame:
        """The table: runs of the newest manifest and the batches after its mark, one row for each key."""
        m = self.manifest()
        paths = [r["path"] for r in m.runs] + [f"updates/batch={b}" for b in self.batches() if b > m.folded]
        return self._merge(self._rows(paths)).select(*self.columns)

    # -- writing

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Log what ``batch`` changes; a replay replaces the batch, one already folded is left alone (False).

        Rows of one key are reduced first; in a ``latest`` table they must be one row a key.
        """
        if batch <= self.manifest().folded:
            return False
        rows = rows.select(*self.columns).withColumn(SEQ, F.lit(batch).cast("long"))
        if self.how == "sum":
            rows = self._merge(rows)
        rows.write.mode("overwrite").parquet(self._folder(batch))
        return True

    def upsert(self, rows: DataFrame) -> int:
        """Log ``rows`` under the next free number, claimed so that two writers never share one."""
        n = max([self.manifest().folded, *self.batches(), *[int(x) for x in self._store.names(f"{self.root}/_claims") if x.isdigit()]],
                default=-1) + 1
        self._store.create(f"{self.root}/_claims/{n}", "")
        self.append(rows, n)
        return n

    def compact(self) -> Manifest:
        """Fold the log and every bucket with ``fan`` runs of one level; returns the newest manifest."""
        m = self.manifest()
        pending = [b for b in self.batches() if b > m.folded]
        # Only batches without a hole before them: an earlier one that is still being written must come first.
        claimed = {int(x) for x in self._store.names(f"{self.root}/_claims") if x.isdigit()}
        gap = min((c for c in claimed if c > m.folded and c not in pending), default=None)
        pending = [b for b in pending if gap is None or b < gap]
        new = Manifest(m.version + 1, pending[-1] if pending else m.folded, list(m.runs))
        if pending:
            new.runs += self._write_run(self._rows([f"updates/batch={b}" for b in pending]), lambda bucket: 1)
        while full := self._full(new.runs):
            held = [r for r in new.runs if full.get(r["bucket"]) == r["level"]]
            rest = [r for r in new.runs if full.get(r["bucket"]) != r["level"]]
            new.runs = rest + self._write_run(self._rows([r["path"] for r in held]), lambda b, f=dict(full): f[b] + 1)
        if new.folded == m.folded and new.runs == m.runs:
            return m
        self._store.create(f"{self.root}/_manifest/{new.version}", new.dump())
        return new

    def _full(self, runs: list[dict]) -> dict[int, int]:
        """``{bucket: lowest level with fan runs}``."""
        count: dict[tuple[int, int], int] = {}
        for r in runs:
            count[r["bucket"], r["level"]] = count.get((r["bucket"], r["level"]), 0) + 1
        out: dict[int, int] = {}
        for (bucket, level), n in sorted(count.items(), reverse=True):
            if n >= self.fan:
                out[bucket] = level
        return out

    def _write_run(self, rows: DataFrame, level) -> list[dict]:
        name = f"runs/{uuid.uuid4().hex}"
        merged = self._merge(rows).withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        merged.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        made = [n for n in self._store.names(f"{self.root}/{name}") if n.startswith(f"{BUCKET}=")]
        return [{"bucket": (b := int(n.split("=")[1])), "level": level(b), "path": f"{name}/{n}"} for n in made]

    def expire(self, keep_versions: int = 2) -> None:
        """Delete folded batches and runs that none of the newest ``keep_versions`` manifests names.

        Run it where no fold is under way: files that a fold has written but not committed look unused too.
        """
        versions = sorted(int(n) for n in self._store.names(f"{self.root}/_manifest") if n.isdigit())
        kept = versions[-keep_versions:]
        if not kept:
            return
        bodies = [json.loads(self._store.read(f"{self.root}/_manifest/{v}")) for v in kept]
        used = {r["path"] for b in bodies for r in b["runs"]}
        for batch in self.batches():
            if batch <= min(b["folded"] for b in bodies):
                self._store.delete(self._folder(batch))
        for run in self._store.names(f"{self.root}/runs"):
            inside = [f"runs/{run}/{n}" for n in self._store.names(f"{self.root}/runs/{run}") if n.startswith(f"{BUCKET}=")]
            for path in inside:
                if path not in used:
                    self._store.delete(f"{self.root}/{path}")
            if not used & set(inside):
                self._store.delete(f"{self.root}/runs/{run}")
        for v in versions[:-keep_versions]:
            self._store.delete(f"{self.root}/_manifest/{v}")
