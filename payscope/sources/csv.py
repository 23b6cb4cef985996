"""CSV postings source (S1 typed-by-cleaning, S2 all strings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from payscope.columns import RAW, PostingColumns


def options(multi_line: bool = True) -> dict[str, object]:
    """Reader options: quoted fields with commas and doubled quotes stay one
    field; a file whose header is not the declared one fails."""
    return {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "enforceSchema": False}


def header_schema(spark: SparkSession, path: str) -> StructType:
    """All-string schema with the names and order of the first file's header.

    Reads one line, no inference pass over the data."""
    names = spark.read.options(header=True, quote='"', escape='"', inferSchema=False).csv(path).columns
    return StructType([StructField(n, StringType(), True) for n in names])


def by_name(df: DataFrame, cols: PostingColumns, extra: tuple[str, ...] = ()) -> DataFrame:
    """The postings columns, whatever their order in the file."""
    wanted = [*cols.names(), *extra]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found in the file: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def read_postings_csv(
    spark: SparkSession,
    path: str,
    cols: PostingColumns = RAW,
    extra: tuple[str, ...] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Read the postings CSV by column name, all strings.

    Further columns are left out; a missing one raises, and so does a file
    whose header differs from the first file's.  Quoted fields may hold line
    breaks; a file is then one task.  For large files without line breaks
    inside fields pass ``multi_line=False``: Spark splits them.
    """
    df = spark.read.schema(header_schema(spark, path)).options(**options(multi_line)).csv(path)
    return by_name(df, cols, extra)
