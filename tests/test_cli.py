"""The command line runs the jobs (in-process, on the test session)."""

from pyspark.sql import functions as F

from brandpulse.cli import main
from brandpulse.session import scratch_path
from conftest import SF001


def _reviews_csv(spark) -> str:
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    lab = spark.read.parquet(f"{SF001}/labels.parquet")
    path = scratch_path(spark, "cli_reviews")
    (d.join(lab, "doc_id").select(F.col("text").alias("content"), F.col("quality").cast("string").alias("recommended"))
     .write.option("header", True).option("escape", '"').csv(path))
    return path


def test_cli_prepare_split_and_train(spark, capsys):
    csv = _reviews_csv(spark)
    labeled, split = scratch_path(spark, "cli_labeled"), scratch_path(spark, "cli_split")
    main(["prepare", csv, labeled])
    lines = spark.read.text(labeled)
    assert lines.where(F.col("value").rlike(":::[01]$")).count() == spark.read.parquet(f"{SF001}/labels.parquet").count()
    main(["split", csv, split])
    parts = spark.read.text(split).select("split", "label").distinct().collect()
    assert {(r["split"], str(r["label"])) for r in parts} <= {(s, l) for s in ("train", "valid") for l in ("0", "1")}
    main(["train", labeled])
    out = capsys.readouterr().out
    assert "Training error:" in out and "Validation error:" in out
