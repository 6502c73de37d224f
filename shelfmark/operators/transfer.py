"""Planning bulk copies: what to move, under which name, in which order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.paths import normalize_path
from shelfmark.operators.ranks import RANGE_ROWS, pages_within, ranked_within


def plan_actions(
    sources: DataFrame, existing: DataFrame, name: str = "label", overwrite: bool = False
) -> DataFrame:
    """Add ``action``: ``copy``, or for a taken name ``skip`` / ``overwrite``."""
    taken = existing.select(F.col(name).alias("_taken")).distinct()
    clash = F.lit("overwrite" if overwrite else "skip")
    action = F.when(F.col("_taken").isNull(), F.lit("copy")).otherwise(clash)
    joined = sources.join(taken, F.col(name) == F.col("_taken"), "left")
    return joined.withColumn("action", action).drop("_taken")


def skip_existing(sources: DataFrame, existing: DataFrame, on: Sequence[str] = ("label",)) -> DataFrame:
    """Only the sources whose target is still free."""
    return sources.join(existing.select(*on).distinct(), list(on), "left_anti")


def first_wins(sources: DataFrame, name: Sequence[str] = ("label",), order: str = "path") -> DataFrame:
    """One source per target name: the first by ``order``, which must be unique.

    An aggregate, so the copies of a hot name are reduced before the shuffle.
    """
    rest = [c for c in sources.columns if c not in name]
    picked = sources.groupBy(*name).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    return picked.select(*name, "_first.*").select(*sources.columns)


def transfer_ordinals(
    files: DataFrame,
    directory: str = "parent",
    order: str = "path",
    slice_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add the 0-based position of each file in the copy of its directory."""
    return ranked_within(files, [directory], [order], "ordinal", range_rows=slice_rows)


def match_counts(
    requests: DataFrame, selected: DataFrame, rid: str = "rid", strict: bool = False
) -> DataFrame:
    """Files selected per request, flagged ``empty`` when there are none."""
    counts = selected.groupBy(rid).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    empty = F.col("n_files") == 0
    if strict:
        nothing = F.raise_error(F.concat(F.lit("nothing selected for "), F.col(rid).cast("string")))
        empty = F.when(empty, nothing.cast("boolean")).otherwise(F.lit(False))
    return (
        requests.join(counts, rid, "left")
        .withColumn("n_files", n)
        .drop("_n")
        .withColumn("empty", empty)
    )


def selected_per_request(requests: DataFrame, selected: DataFrame, strict: bool = False) -> DataFrame:
    """``match_counts`` of ``requests(rid, path)`` over selected files ``(path, parent)``.

    Files are counted once per directory and once per path, and the counts are
    joined to the requests, so no request meets a file.
    """
    target = F.explode(F.array("path", "parent")).alias("_target")
    counts = selected.select(target).groupBy("_target").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0)).cast("long")
    empty = F.col("n_files") == 0
    if strict:
        nothing = F.raise_error(F.concat(F.lit("nothing selected for "), F.coalesce("path", F.lit("null"))))
        empty = F.when(empty, nothing.cast("boolean")).otherwise(F.lit(False))
    joined = requests.join(counts, normalize_path(F.col("path")) == F.col("_target"), "left")
    return joined.withColumn("n_files", n).drop("_n", "_target").withColumn("empty", empty)


def pulled_names(
    files: DataFrame,
    target: str = "parent",
    name: str = "label",
    page_size: int = 1000,
    slice_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Comma-joined file names per target, ``page_size`` names to a line."""
    paged = pages_within(
        files.select(target, name), [target], [name], page_size, range_rows=slice_rows
    )
    listed = F.array_join(F.sort_array(F.collect_list(name)), ", ")
    return paged.groupBy(target, "page").agg(listed.alias("names"))
