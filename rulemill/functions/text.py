"""Text patterns and small string expressions shared by operators and SQL checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO 8601 date, or date-time with optional fraction and zone.
ISO_8601 = (r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
            r"([T ]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.][0-9]+)?)?"
            r"(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"


def shape(col: Column) -> Column:
    """Generalise text: letters to A, digits to 9, other characters kept."""
    return F.regexp_replace(F.regexp_replace(col, "[A-Za-z]", "A"), "[0-9]", "9")


def squeeze(col: Column) -> Column:
    """Lower-case, collapse blanks, trim."""
    return F.trim(F.regexp_replace(F.lower(col), "[ \\t\\r\\n]+", " "))


def squeeze_code(col: Column) -> Column:
    """``squeeze``, but quoted text keeps its case and its blanks."""
    parts = F.transform(F.split(col, "'"), lambda x, i: F.when(i % 2 == 1, x).otherwise(F.regexp_replace(F.lower(x), "[ \\t\\r\\n]+", " ")))
    return F.trim(F.array_join(parts, "'"))


def fingerprint(col: Column, length: int = 12) -> Column:
    """Leading hex digits of SHA-256."""
    return F.substring(F.sha2(col, 256), 1, length)


def strip_fence(col: Column) -> Column:
    """Trim model text and remove an opening and a closing code fence."""
    opened = F.regexp_replace(F.trim(F.regexp_replace(col, "^\\s+|\\s+$", "")), "^```[A-Za-z0-9_-]*\\s*", "")
    return F.regexp_replace(F.regexp_replace(opened, "\\s*```$", ""), "^\\s+|\\s+$", "")


def tokens(col: Column) -> Column:
    """Lower-case words: runs of letters and digits of any script."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
