"""Sinks.

Writers never overwrite a path that the written plan reads from: a keyed merge
writes a new version folder and returns its path. Output parallelism is the
plan's own unless ``num_files`` asks for a ``repartition`` (the reference's
parallelism level of 64) or ``single_file`` for one file (``coalesce(1)``; only
for small outputs, it funnels the write through one task).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.functions.text import LABELED_NONE
from brandpulse.operators.labels import one_line, serialize_labeled
from brandpulse.operators.upsert import upsert_latest
from brandpulse.session import shuffles_freed

PREDICTIONS_SCHEMA = (
    "airline STRING, id STRING, processing_time TIMESTAMP_NTZ, processing_id STRING, comment STRING, "
    "retweets BIGINT, prediction INT"
)
SCORES_SCHEMA = "airline STRING, score DOUBLE, processing_id STRING, total_comments BIGINT, positive_comments BIGINT"


def _shape(df: DataFrame, num_files: int | None, single_file: bool, partition_cols: list[str] | None = None) -> DataFrame:
    """Output layout: one file, a fixed number of files, or AQE-rebalanced by the partition columns.

    Without a shuffle a ``partitionBy`` write makes every task open one file per
    partition value (tasks x values small files). ``rebalance`` groups rows by
    the partition columns and lets AQE split a value that holds many rows (a hot
    brand) over several tasks and merge small ones.
    """
    if single_file:
        return df.coalesce(1)
    if num_files:
        # Rows are dealt round the files, not by the partition columns: a hot brand is spread over all tasks.
        return df.repartition(num_files)
    if partition_cols:
        return df.hint("rebalance", *partition_cols)
    return df


def write_label_split(df: DataFrame, path: str, single_file: bool = False, fmt: str = "text",
                      compat: bool = False) -> None:
    """K1: the four positive/negative x train/valid outputs as one partitioned write.

    ``df`` is ``labels.label_split`` output; folders are ``split=<s>/label=<l>``. As text, a review is one
    line (line breaks become spaces; ``compat`` leaves them raw) and a missing one is the text 'None'.
    """
    text = F.col("sentiment")
    if fmt == "text":
        text = F.coalesce(text if compat else one_line(text), F.lit(LABELED_NONE))
    out = df.select("split", "label", text.alias("sentiment"))
    # single_file: one file per output folder, as the reference's coalesce(1) per part.
    out = out.repartition("split", "label") if single_file else _shape(out, None, False, ["split", "label"])
    writer = out.write.mode("error").partitionBy("split", "label")
    if fmt == "text":
        writer.text(path)
    else:
        writer.format(fmt).save(path)


def write_labeled_text(df: DataFrame, path: str, content_col: str = "content", label_col: str = "recommended",
                       single_file: bool = False, compat: bool = False) -> None:
    """K2: ``<content>:::<label>`` lines, one for each review (see ``labels.serialize_labeled``)."""
    out = _shape(df.select(serialize_labeled(content_col, label_col, compat).alias("value")), None, single_file)
    out.write.mode("error").text(path)


def run_folder(path: str, run_id: str) -> str:
    """The folder of one run's prediction rows."""
    return f"{path.rstrip('/')}/processing_id={run_id}"


def write_predictions(df: DataFrame, path: str, run_id: str, num_files: int | None = None,
                      partition_by_term: bool = True, rows_of: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K3: one run's prediction rows, keyed by ``(airline, id)`` within the run.

    A run owns the folder ``processing_id=<run_id>`` and replaces it as a whole, so writing the same run again
    (after a lost job, or with the same id) repeats no row; other runs are not touched. Inside, rows are
    partitioned by ``airline``, so a per-brand read prunes partitions.

    ``rows_of`` makes the prediction rows of what ``df`` holds (one row for each text and brand, say) after it was dealt to
    the files, so a text is moved once for each brand and not for each mention. The files are packed by zstd, whose
    window spans the neighbouring rows of one text.
    """
    out = _shape(df, num_files, False, ["airline"] if partition_by_term else None)
    writer = (rows_of(out) if rows_of else out).drop("processing_id").write.mode("overwrite").option("compression", "zstd")
    if partition_by_term:
        writer = writer.partitionBy("airline")
    with shuffles_freed(df.sparkSession):
        writer.parquet(run_folder(path, run_id))


def read_predictions(spark, path: str, run_id: str | None = None) -> DataFrame:
    """K3 read back: all runs, or one run's folder only (no scan of the others)."""
    cols = [c.split()[0] for c in PREDICTIONS_SCHEMA.split(", ")]
    if run_id is None:
        return spark.read.schema(PREDICTIONS_SCHEMA).parquet(path).select(*cols)
    own = ", ".join(c for c in PREDICTIONS_SCHEMA.split(", ") if not c.startswith("processing_id"))
    one = spark.read.schema(own).parquet(run_folder(path, run_id))
    return one.withColumn("processing_id", F.lit(run_id)).select(*cols)


def write_scores_version(spark, scores: DataFrame, table_root: str, key_cols: list[str] | None = None) -> str:
    """K4: keyed last-write-wins merge of ``scores`` into the latest version under ``table_root``.

    Entities not in this run keep their previous row. Each merge writes the
    next ``version=<n>`` folder (mode ``error``: a concurrent writer of the same
    version fails instead of overwriting) and never touches the one it reads.
    A version counts once its commit marker is there; an unfinished one is skipped and its number not reused.
    """
    key_cols = key_cols or ["airline"]
    versions = _versions(spark, table_root)
    done = [v for v, committed in versions if committed]
    merged = scores
    if done:
        old = _version(spark, table_root, max(done))
        merged = upsert_latest(old, scores.select(*old.columns), key_cols)
    target = f"{table_root.rstrip('/')}/version={max((v for v, _ in versions), default=-1) + 1}"
    merged.write.mode("error").parquet(target)
    return target


def latest_scores(spark, table_root: str) -> DataFrame:
    """Read the newest committed version written by ``write_scores_version``."""
    done = [v for v, committed in _versions(spark, table_root) if committed]
    if not done:
        raise FileNotFoundError(f"no score versions under {table_root}")
    return _version(spark, table_root, max(done))


def _version(spark, table_root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{table_root.rstrip('/')}/version={version}")


def _versions(spark, table_root: str) -> list[tuple[int, bool]]:
    """Version folders under ``table_root`` and whether each is committed, from the folder listing alone."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(table_root)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("version=") and name[8:].isdigit():
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            out.append((int(name[8:]), bool(fs.exists(marker))))
    return sorted(out)


def error_report(report: DataFrame) -> list[str]:
    """K8: the reference's report lines ('Training error:<e>') from an error table (small)."""
    names = {"train": "Training error:", "valid": "Validation error:", "samples": "Samples error:", None: "Samples error:"}
    rows = [r.asDict() for r in report.collect()]  # one row per split: bounded by the number of splits
    return [f"{names.get(r.get('split'), 'Error:')}{r['error']}" for r in rows]


def with_run_columns(mentions: DataFrame, run_id: str, processing_time, id_cols: list) -> DataFrame:
    """Run id, processing time and a stable row id (sha-256 of the row's identity).

    A stable id survives recomputation after a lost executor; ``uuid()`` would
    make a retried task emit different ids and duplicate rows.
    """
    return mentions.withColumns({
        "processing_id": F.lit(run_id),
        "processing_time": F.lit(processing_time).cast("timestamp_ntz"),
        "id": F.sha2(F.concat_ws("|", F.lit(run_id), *id_cols), 256),
    })
