"""Literal search and replace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_literal(text: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    """Replace every occurrence of ``pattern``; both strings are literal."""
    if not ignore_case and pattern:
        return F.replace(text, F.lit(pattern), F.lit(replacement))
    flags = "(?iu)" if ignore_case else ""
    quoted = "\\Q" + pattern.replace("\\E", "\\E\\\\E\\Q") + "\\E" if pattern else ""
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, flags + quoted, literal)
