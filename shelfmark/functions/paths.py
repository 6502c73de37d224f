"""Path arithmetic as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_path(path: Column) -> Column:
    """Drop trailing slashes, so ``/a/b/`` and ``/a/b`` are one key; ``/`` stays."""
    bare = F.rtrim(path, F.lit("/"))
    return F.when((bare == "") & (path != ""), F.lit("/")).otherwise(bare)


def label_of(path: Column) -> Column:
    """Last segment; empty for a path with a trailing slash."""
    return F.substring_index(path, "/", -1)


def parent_of(path: Column) -> Column:
    """Everything before the last slash; ``/`` for a top-level path."""
    slash = F.length(path) - F.length(label_of(path))
    return (
        F.when(slash == 0, F.lit(""))
        .when(slash == 1, F.lit("/"))
        .otherwise(F.substring(path, F.lit(1), slash - 1))
    )


def join_path(prefix: Column, name: Column) -> Column:
    """``prefix/name``; an absolute ``name`` replaces the prefix."""
    return (
        F.when(F.startswith(name, F.lit("/")) | (prefix == ""), name)
        .when(F.endswith(prefix, F.lit("/")), F.concat(prefix, name))
        .otherwise(F.concat(prefix, F.lit("/"), name))
    )


def under_home(path: Column, home: str) -> Column:
    """True when ``path`` lies below the home root; null paths are not."""
    root = home.rstrip("/") + "/"
    return F.coalesce(F.startswith(path, F.lit(root)), F.lit(False))
