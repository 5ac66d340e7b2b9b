"""Session helpers: a local session for tests/bench, and the shared scratch folder.

On a cluster the session is built by the caller (spark-submit); the library only
reads settings from it. The one setting we rely on is ``spark.checkpoint.dir``,
the shared folder where lineage is cut and intermediate tables are written. We
set our own only when the session has none and the master is local; on a cluster
a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
FREE_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "brandpulse") -> SparkSession:
    """A local[N] session configured like the tests and the bench (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; one of our own only if unset and the master is local.

    Also registers it as the SparkContext checkpoint dir so ``DataFrame.checkpoint()``
    (reliable, never ``localCheckpoint``) works.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session has no SparkContext
        sc = None
    root = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        # Local runs only (tests, bench): driver and tasks are one process on one machine.
        root = tempfile.mkdtemp(prefix="brandpulse-ckpt-", dir=os.environ.get("BRANDPULSE_SCRATCH", "/tmp"))
        try:
            spark.conf.set(CHECKPOINT_CONF, root)
        except Exception:  # noqa: BLE001 - core settings may be read-only at runtime
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their own shuffle files as soon as they are done, not when the driver's JVM collects garbage.

    Only for rows that are read from the written files afterwards. A session's own setting comes back at the end.
    """
    before = spark.conf.get(FREE_SHUFFLES_CONF, None)
    spark.conf.set(FREE_SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES_CONF)
        else:
            spark.conf.set(FREE_SHUFFLES_CONF, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh scratch folder, packed tightly, and read from there (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
