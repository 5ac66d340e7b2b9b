"""Command line for the jobs, one sub-command per reference script role.

    spark-submit brandpulse/cli.py score   <messages dir> <reviews.csv> <output root> [--compat] [--mode M]
    spark-submit brandpulse/cli.py train   <labelled text> [--samples <parquet with a text column>]
    spark-submit brandpulse/cli.py split   <reviews.csv> <output dir>
    spark-submit brandpulse/cli.py prepare <reviews.csv> <output dir>
    spark-submit brandpulse/cli.py target  <messages dir> <labelled text> <output root>
    spark-submit brandpulse/cli.py ingest  <collected files dir> <output dir> [--once]

Outputs are Parquet tables under the output root (``predictions/``, ``scores/``, ``ranking/``)
instead of the reference's table store; the checkpoint folder comes from the
session (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from brandpulse.defaults import REFERENCE_TERMS  # noqa: E402
from brandpulse.plans import composites as C  # noqa: E402
from brandpulse.sinks.writers import error_report, write_predictions  # noqa: E402
from brandpulse.sources.readers import read_json_lines, read_reviews_csv  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="brandpulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("score", help="C1: classify messages and score brands")
    s.add_argument("messages"); s.add_argument("reviews"); s.add_argument("out")
    s.add_argument("--terms", default=REFERENCE_TERMS); s.add_argument("--mode", default=None)
    s.add_argument("--compat", action="store_true")
    t = sub.add_parser("train", help="C5: train on labelled text and print the error report")
    t.add_argument("labeled"); t.add_argument("--samples", default=None)
    p = sub.add_parser("split", help="C4: split reviews into positive/negative x train/valid")
    p.add_argument("reviews"); p.add_argument("out")
    r = sub.add_parser("prepare", help="C2: reviews CSV to labelled text")
    r.add_argument("reviews"); r.add_argument("out")
    g = sub.add_parser("target", help="C3: predictions from a labelled-text model")
    g.add_argument("messages"); g.add_argument("labeled"); g.add_argument("out")
    g.add_argument("--terms", default=REFERENCE_TERMS); g.add_argument("--compat", action="store_true")
    i = sub.add_parser("ingest", help="C6: route collected records per term (streaming)")
    i.add_argument("src"); i.add_argument("out"); i.add_argument("--terms", default=REFERENCE_TERMS)
    i.add_argument("--checkpoint", default=None, help="stable checkpoint folder (default: <out>_checkpoint)")
    i.add_argument("--once", action="store_true", help="process what is there and stop (availableNow)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"brandpulse-{args.cmd}").getOrCreate()
    if args.cmd == "score":
        scores, report = C.run_score_job_report(
            spark, read_json_lines(spark, args.messages), read_reviews_csv(spark, args.reviews),
            args.terms, f"{args.out}/predictions", f"{args.out}/scores", mode=args.mode, compat=args.compat)
        for line in error_report(report):
            print(line)
        ranked = C.ranking(scores)
        ranked.write.mode("overwrite").parquet(f"{args.out}/ranking")
        print(f"ranking: {args.out}/ranking; its first rows:")
        ranked.orderBy("rank", "airline").show(20, truncate=False)
    elif args.cmd == "train":
        samples = spark.read.parquet(args.samples) if args.samples else None
        _, report = C.train_and_report_text(spark, args.labeled, samples=samples)
        for line in error_report(report):
            print(line)
    elif args.cmd == "split":
        C.split_reviews(spark, args.reviews, args.out)
    elif args.cmd == "prepare":
        C.prepare_reviews(spark, args.reviews, args.out)
    elif args.cmd == "target":
        res = C.score_from_saved_text(spark, read_json_lines(spark, args.messages), args.labeled, args.terms,
                                      compat=args.compat)
        for line in error_report(res.report):
            print(line)
        write_predictions(res.predictions, f"{args.out}/predictions", res.run_id)
    elif args.cmd == "ingest":
        from brandpulse.streaming.ingest import route_stream

        # The checkpoint must be the same folder on every start: that is how a
        # restarted query resumes where it stopped (no record lost or repeated).
        checkpoint = args.checkpoint or args.out.rstrip("/") + "_checkpoint"
        q = route_stream(spark, args.src, args.out, checkpoint, args.terms, available_now=args.once)
        q.awaitTermination()


if __name__ == "__main__":
    main()
