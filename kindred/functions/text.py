"""Text helpers: feature-name cleaning, blank handling, regex tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feature-name cleaning rules, applied in this order
# (search text, replacement), then the result is lower-cased.
NAME_RULES = [
    ("(", "_"),
    (")", ""),
    (" & ", "_and_"),
    (" ", "_"),
    ("-", "_"),
    ("'s", ""),
    ("'", ""),
    ("/", ""),
]

BLANK_PATTERN = r"^\s*$"


def clean_name_str(value) -> str:
    """Clean one category value into a feature-name fragment (driver side)."""
    out = str(value)
    for old, new in NAME_RULES:
        out = out.replace(old, new)
    return out.lower()


def clean_name(col: Column | str) -> Column:
    """The same cleaning as a column expression."""
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("string")
    for old, new in NAME_RULES:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.lower(c)


def blank_to_other(col: Column | str, other: str = "other") -> Column:
    """Null, empty or all-whitespace text becomes ``other``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull() | c.rlike(BLANK_PATTERN), F.lit(other)).otherwise(c)


def matches(col: Column | str, pattern: str, case_sensitive: bool = True) -> Column:
    """Regex search; null input gives false (no match)."""
    c = F.col(col) if isinstance(col, str) else col
    p = pattern if case_sensitive else "(?i)" + pattern
    return F.coalesce(c.rlike(p), F.lit(False))


def word_count(col: Column | str) -> Column:
    """Number of word tokens (Unicode letters, digits, underscore)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_count(c, F.lit(r"[\p{L}\p{N}_]+"))
