"""Shared pieces of the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back.

    The table cuts the lineage: what Python or a shuffle made is not made
    again by later stages, and it outlives a lost executor.  zstd keeps it
    small on disk.
    """
    path = os.path.join(checkpoint_dir(df.sparkSession), f"llm-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only ``columns`` of ``df``, so that further columns of any name cannot
    clash with those an operator makes."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
