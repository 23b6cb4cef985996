"""Salary expressions: text -> double, pay frequency -> yearly basis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Yearly multipliers per pay frequency
# (40 h x 52 weeks = 2080 hours, 5 days x 52 weeks = 260 days).
ANNUAL_FACTORS = {"Annual": 1, "Hourly": 2080, "Daily": 260}


def strip_to_double(c: Column | str) -> Column:
    """Keep digits and dots only, then parse; unusable text gives null.

    ``try_cast`` because Spark 4 (ANSI) raises on ``''`` or ``'1.2.3'``.
    The minus sign is stripped too, so ``'-5'`` parses as 5.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"[^\d.]", "").try_cast("double")


def coerce_double(c: Column | str) -> Column:
    """Strict numeric parse: anything that is not a number gives null."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def annualize(value: Column, frequency: Column, unknown: str = "keep") -> Column:
    """Bring a pay value to a yearly basis.

    ``unknown='keep'`` leaves values with any other frequency as they are
    (batch pipeline); ``unknown='null'`` nulls them (exploration variant).
    Written as ``value * factor`` so the (often long) value expression
    occurs once: when the optimizer inlines it into filters or grouping
    keys, a branch per frequency would copy it each time.
    """
    if unknown not in ("keep", "null"):
        raise ValueError("unknown must be 'keep' or 'null'")
    factor = None
    for name, f in ANNUAL_FACTORS.items():
        factor = (F.when(frequency == name, F.lit(f)) if factor is None
                  else factor.when(frequency == name, F.lit(f)))
    factor = factor.otherwise(F.lit(1) if unknown == "keep" else F.lit(None).cast("int"))
    return value * factor
