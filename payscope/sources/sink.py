"""KPI sink (S3): one header CSV per KPI, by its name, under a dated run folder."""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from payscope.session import delete_folder


def write_kpi_csv(df: DataFrame, name: str, output_dir: str, run_date: str | None = None,
                  order_by: Sequence[Column | str] = ()) -> str:
    """Write a KPI result as ``output_dir/yyyymmdd/name.csv``; returns that path.

    Only the finished rows (one per group) go to the one writing task, and are
    put in order there: ``repartition(1)`` leaves the aggregation upstream
    its own parallelism, which ``coalesce(1)`` would take away.  The task writes
    into an attempt folder beside the target.  Its one part is then renamed over
    the target, so readers see the old file or the new one, never a part of it; a
    failed run leaves the old file.
    """
    spark = df.sparkSession
    run_date = run_date or _dt.date.today().strftime("%Y%m%d")
    folder = os.path.join(output_dir, run_date)
    attempt = os.path.join(folder, f"_attempt-{name}-{uuid.uuid4().hex}")
    one = df.repartition(1)
    one = one.sortWithinPartitions(*order_by) if order_by else one
    try:
        one.write.option("header", True).option("escape", '"').csv(attempt)
        return commit_part(spark, attempt, os.path.join(folder, f"{name}.csv"))
    finally:
        delete_folder(spark, attempt)


def commit_part(spark: SparkSession, attempt: str, target: str) -> str:
    """Rename the only part file of ``attempt`` to ``target``, over an older one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    source = fs.Path(attempt, "part-*")
    parts = [x.getPath() for x in source.getFileSystem(conf).globStatus(source) or []]
    if len(parts) != 1:
        raise FileNotFoundError(f"{attempt} holds {len(parts)} part files, not one")
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(parts[0].toUri(), conf).rename(parts[0], fs.Path(target), options)
    return target
