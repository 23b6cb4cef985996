"""Spark session and storage helpers.

Settings follow the execution model the operators are written for: AQE on
(coalescing, skew-join splitting), UTC session time, no UI.  On a cluster the
session comes from the launcher; only tests and the bench build their own.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app: str = "payscope",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it is set by whoever runs the job and is read, never
    overridden.  Only when it is unset may a caller (tests, local runs)
    install ``fallback``; without one this raises rather than silently use
    a folder that exists on one machine only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for "
                           "materialized tables and stream checkpoints")
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir() or fallback


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, whichever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                made: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage so later stages do not recompute the upstream shuffles,
    and, unlike caching, survives the loss of executors because the files
    live on shared storage.  ``partition_by`` lays the files out by those
    columns so that filters on them skip whole folders.  The folder's path is
    added to ``made``, for ``delete_folder`` once nothing reads it any more.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver
    happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


@contextmanager
def stored_in_turn(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``materialize`` for a chain of tables each made from the one before: the one
    before is deleted, and the shuffles between them are, so the disk holds one link
    of the chain at a time.  Nothing else may read a table of the chain but its last,
    and nothing that one after the block, which deletes it."""
    made: list[str] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(spark):
            df = materialize(df, name, made=made, compression="zstd")
        while len(made) > 1:
            delete_folder(spark, made.pop(0))
        return df

    try:
        yield store
    finally:
        for path in made:
            delete_folder(spark, path)
