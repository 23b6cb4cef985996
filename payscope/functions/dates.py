"""Date and timestamp parsing (null on bad text instead of raising)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ISO layout of the posting date columns.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def parse_date(c: Column | str, fmt: str = ISO_FORMAT) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(c, fmt)


def parse_timestamp(c: Column | str, fmt: str = ISO_FORMAT) -> Column:
    """Wall-clock timestamp without zone (same value under any session tz)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
