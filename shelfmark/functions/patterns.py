"""Substring patterns and the include/exclude rule, as single predicates.

A pattern is neither a glob nor a regular expression: it matches when it occurs
anywhere in the whole path, ignoring case.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(terms: Sequence[Column]) -> Column:
    """OR the terms as a balanced tree; false when there are none.

    Plain ORs stay inside whole-stage codegen, which ``F.exists`` over an array
    does not; the balance keeps long lists from nesting deeply.
    """
    if not terms:
        return F.lit(False)
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return any_of(terms[:half]) | any_of(terms[half:])


def matches_any(path: Column, patterns: Sequence[str] | None) -> Column:
    lowered = F.lower(path)
    return any_of([F.contains(lowered, F.lower(F.lit(p))) for p in patterns or ()])


def named_in(label: Column, path: Column, names: Sequence[str] | None) -> Column:
    """Include-by-name: the basename or the full path is listed, case-sensitively."""
    if not names:
        return F.lit(False)
    return label.isin(*names) | path.isin(*names)


def labelled_in(label: Column, names: Sequence[str] | None) -> Column:
    """Exclude-by-name: only the basename counts."""
    return label.isin(*names) if names else F.lit(False)


@dataclass(frozen=True)
class FileRules:
    """Includes apply first, excludes second.  None and empty mean the same.

    Without any include list every file is included; otherwise a file must match
    an include pattern or an include name.
    """

    include_patterns: Sequence[str] | None = None
    include_names: Sequence[str] | None = None
    exclude_patterns: Sequence[str] | None = None
    exclude_names: Sequence[str] | None = None

    def predicate(self, path: Column, label: Column) -> Column:
        keep = F.lit(True)
        if self.include_patterns or self.include_names:
            keep = matches_any(path, self.include_patterns) | named_in(
                label, path, self.include_names
            )
        if self.exclude_patterns:
            keep = keep & ~matches_any(path, self.exclude_patterns)
        if self.exclude_names:
            keep = keep & ~labelled_in(label, self.exclude_names)
        return keep
