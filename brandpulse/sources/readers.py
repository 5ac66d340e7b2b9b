"""Sources.

Readers return DataFrames with explicit schemas (no inference pass over the
data). Message records are kept as raw JSON lines and parsed with a one-field
``from_json`` so only the fields a query uses are materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEW_SCHEMA = "content STRING, recommended STRING"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str, partitions: int | None = None) -> DataFrame:
    """A driver test table; ``cols`` prunes the scan.

    ``partitions``: deal the rows to so many partitions where the scan has fewer splits than the session has cores
    (a small file of text-heavy rows is a single split); a large input has splits enough and is not shuffled.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*cols) if cols else df
    if partitions and df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        return df.repartition(partitions)
    return df


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file under ``path`` as ``value`` (raw JSON record)."""
    return spark.read.text(path)


def read_reviews_csv(spark: SparkSession, path: str, schema: str | None = None, content_col: str = "content",
                     label_col: str = "recommended", multi_line: bool = True) -> DataFrame:
    """Review CSV with a header, every column a string.

    RFC-4180 quote doubling. ``multi_line``: texts may hold line breaks; a file is then one task. Files whose
    texts hold none should be read with ``multi_line=False``: they are split like any text. With
    an explicit ``schema`` the header is only skipped; without one the columns are
    taken from the header as strings (no type inference pass).
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if schema:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df.select(content_col, label_col) if not schema else df


def read_labeled_text(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``<content>:::<label>`` lines as ``value`` (parse with ``labels.parse_labeled``)."""
    return spark.read.text(path)


def literal_samples(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A literal relation (``createDataFrame`` with an explicit DDL schema)."""
    return spark.createDataFrame(rows, ddl)


def stream_json_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Continuous scan of JSON-lines files landing in ``path`` (``value`` column)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


__all__ = [
    "REVIEW_SCHEMA",
    "literal_samples",
    "read_json_lines",
    "read_labeled_text",
    "read_reviews_csv",
    "read_table",
    "stream_json_lines",
]
