"""Text expressions: keyword patterns, trimming, capitalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A "word character" for keyword boundaries: any letter, decimal digit or
# underscore.  This is what a Unicode-aware \b treats as part of a word, so
# "the" is not found inside "théme", while "c++" and "c#" can be found as
# themselves (a plain \b after "+" would demand a letter to follow).
WORD = r"[\p{L}\p{Nd}_]"
_META = set("\\.^$|?*+()[]{}")

# Blanks as Unicode has them; the last is U+3000.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in _META else ch for ch in s)


def bounded(keyword: str) -> str:
    """Pattern that finds ``keyword`` only as a whole word."""
    return f"(?<!{WORD}){regex_escape(keyword)}(?!{WORD})"


def keyword_alternation(keywords: Iterable[str]) -> str:
    """One capturing alternation, longest keyword first.

    Longest first makes the leftmost match also the longest one, so
    "vendor management" wins over "management" at the same position.
    """
    uniq = sorted(set(k.lower() for k in keywords), key=lambda k: (-len(k), k))
    body = "|".join(regex_escape(k) for k in uniq)
    return f"(?<!{WORD})({body})(?!{WORD})"


def strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def capitalize_first(c: Column) -> Column:
    """First character upper case, the rest lower case (not initcap)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def lower_concat(cols: Iterable[str], null_as_empty: bool = True) -> Column:
    """lower(c1 || ' ' || c2 ...); nulls count as '' (or are skipped)."""
    parts = [F.coalesce(F.col(c), F.lit("")) if null_as_empty else F.col(c) for c in cols]
    return F.lower(F.concat_ws(" ", *parts))
