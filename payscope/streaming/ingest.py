"""Incremental ingestion of posting CSV drops.

Only the row-wise operators run on the stream: salary midpoint (C2), date
parse (C4, keeping the ISO text for later ordering), yearly pay (C6),
primary category (C8), qualification (T1) and combined text (T3).  They need
no state, so every micro-batch is cleaned independently.  Dedup (C1) and the
median-based pay bands (T2) need the whole table and run as batch jobs on
the ingested table, which is written by the parquet file sink (exactly-once
through its commit log) and partitioned by posting year.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payscope.columns import POSTING_DATE, RAW, PostingColumns
from payscope.operators import clean as C
from payscope.operators import features as T
from payscope.session import checkpoint_dir
from payscope.sources import csv

YEAR = "posting_year"


def clean_stream(df: DataFrame, cols: PostingColumns = RAW) -> DataFrame:
    """Apply the stateless cleaning and feature operators (batch or stream)."""
    df = C.salary_to_numeric(df, cols.salary_from, cols.salary_to)
    df = C.posting_date_to_date(df, cols.posting_date, drop_source=False)
    df = C.normalize_to_annual(df, cols.salary_frequency)
    df = C.primary_category(df, cols.job_category)
    df = T.categorize_qualification(df, cols.min_qual)
    df = T.combined_text(df, [cols.preferred_skills, cols.job_description, cols.min_qual])
    return df.withColumn(YEAR, F.year(POSTING_DATE))


def ingest(spark: SparkSession, source_dir: str, table_dir: str, cols: PostingColumns = RAW,
           checkpoint: str | None = None, max_files_per_trigger: int | None = None,
           multi_line: bool = True) -> StreamingQuery:
    """Clean every new CSV file under ``source_dir`` into ``table_dir``.

    Columns are read by name; the header of the files present at the start
    is declared for all, and a file with another header fails the batch.

    Runs with ``availableNow``: processes what has arrived, then stops, so it
    can be scheduled like a batch job while keeping streaming bookkeeping
    (each file is read once).  The checkpoint goes under the shared
    ``spark.checkpoint.dir`` unless given.
    """
    reader = spark.readStream.schema(csv.header_schema(spark, source_dir)).options(**csv.options(multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cleaned = clean_stream(csv.by_name(reader.csv(source_dir), cols), cols)
    if checkpoint is None:
        checkpoint = os.path.join(checkpoint_dir(spark), "ingest-" + os.path.basename(table_dir.rstrip("/")))
    return (cleaned.writeStream.format("parquet")
            .option("path", table_dir)
            .option("checkpointLocation", checkpoint)
            .partitionBy(YEAR)
            .outputMode("append")
            .trigger(availableNow=True)
            .start())


def read_ingested(spark: SparkSession, table_dir: str) -> DataFrame:
    """The ingested table (only files committed by the sink are visible)."""
    return spark.read.parquet(table_dir)
