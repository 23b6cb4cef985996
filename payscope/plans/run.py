"""Command-line job: postings CSV -> clean -> enrich -> four KPI CSVs.

    python -m payscope --input 'postings/*.csv' --output out/ \\
        [--tiebreak 'Posting Updated' ...] [--keywords python sql ...]

Runs in the session the launcher provides (``spark-submit`` settings, with
``spark.checkpoint.dir`` naming a shared folder for the materialized
table).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from payscope.columns import RAW
from payscope.plans import jobs
from payscope.sources.csv import read_postings_csv


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="payscope", description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True, help="postings CSV path or glob")
    ap.add_argument("--output", required=True, help="folder for the dated KPI files")
    ap.add_argument("--tiebreak", nargs="*", default=[], help="columns that order same-date duplicates")
    ap.add_argument("--keywords", nargs="*", default=None, help="skill vocabulary (default: taxonomy)")
    ap.add_argument("--run-date", default=None, help="yyyymmdd folder name (default: today)")
    ap.add_argument("--single-line", action="store_true", help="no line breaks inside fields: large files are split")
    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("payscope").getOrCreate()
    raw = read_postings_csv(spark, args.input, multi_line=not args.single_line)
    made: list[str] = []
    enriched = jobs.enrich(jobs.clean(raw, RAW, tuple(args.tiebreak)), RAW, checkpoint_input=True, made=made)
    out = jobs.report(enriched, args.output, RAW, keywords=args.keywords, run_date=args.run_date, made=made)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
