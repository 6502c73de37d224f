"""Positions and pages inside groups, safe for groups of any size.

A window over a whole group is one task.  Here every group is cut into slices at
bounds taken from a sample of its own rows, each slice is numbered alone, and
the rows of earlier slices are added on.  The bounds are values that the plan
itself computes, so a row's slice is a fixed expression: no job runs while the
plan is built, nothing is checkpointed, and a recomputed task finds the same
slices.  A group of up to ``slice_rows`` rows has no bounds and is one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A task sorts this many narrow rows without trouble.
SLICE_ROWS = 1_000_000
# Rows sampled from a group, and so the most slices it can have.
_SAMPLED = 1024


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    into: str = "ordinal",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in its group, ordered by ``order``.

    Rows that agree in all of ``order`` share a slice and are numbered in any
    order; name enough columns to tell rows of a hot group apart.
    """
    place = F.struct(*order)
    bounds = _slice_bounds(df, keys, place, slice_rows)
    sliced = df.join(bounds, _same(df, bounds, keys), "left").drop(*_named(keys))
    # The number of bounds at or below the row; null bounds are one slice.
    below = F.size(F.filter("_bounds", lambda bound: bound <= place))
    sliced = sliced.withColumn("_slice", F.when(F.col("_bounds").isNull(), 0).otherwise(below))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.filter(F.col("_bounds").isNotNull())
        .groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*_renamed(keys), F.col("_slice").alias("_at"), F.sum("_rows").over(earlier).alias("_before"))
    )
    sliced = sliced.drop("_bounds")
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order)).cast("long") - 1
    numbered = sliced.withColumn("_inside", inside)
    matched = _same(numbered, offsets, keys) & (F.col("_slice") == F.col("_at"))
    joined = numbered.join(offsets, matched, "left")
    return joined.select(
        *[numbered[c] for c in df.columns], (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(into)
    )


def _named(keys: Sequence[str]) -> list[str]:
    return [f"_key_{k}" for k in keys]


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_key_{k}") for k in keys]


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & left[key].eqNullSafe(right[f"_key_{key}"])
    return same


def _slice_bounds(df: DataFrame, keys: Sequence[str], place: Column, slice_rows: int) -> DataFrame:
    """``_key_*, _bounds`` of the groups of more than ``slice_rows`` rows.

    Each group's rows are dealt by a hash into ``_SAMPLED`` cells, and the row
    of the smallest hash stands for its cell; both steps combine before the
    shuffle.  Of the sampled places evenly spaced ones become bounds.
    """
    mark = F.xxhash64(place)
    cells = (
        df.select(*_renamed(keys), place.alias("_place"), mark.alias("_mark"))
        .groupBy(*_named(keys), F.pmod("_mark", F.lit(_SAMPLED)).alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.min_by("_place", "_mark").alias("_place"))
    )
    groups = cells.groupBy(*_named(keys)).agg(
        F.sum("_rows").alias("_rows"), F.sort_array(F.collect_list("_place")).alias("_places")
    )
    slices = F.least(F.ceil(F.col("_rows") / slice_rows), F.size("_places").cast("long"))
    step = F.size("_places") / slices
    picked = F.transform(
        F.sequence(F.lit(1).cast("long"), slices - 1), lambda k: F.get("_places", F.floor(k * step).cast("int"))
    )
    return groups.filter((F.col("_rows") > slice_rows) & (slices > 1)).select(*_named(keys), picked.alias("_bounds"))


def page_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    page_size: int,
    into: str = "page",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add a 0-based page number, ``page_size`` rows of a group to a page.

    Grouping by the keys and the page then collects at most one page per row,
    however large the group is.
    """
    if page_size < 1:
        raise ValueError("page_size must be 1 or more")
    numbered = number_within(df, keys, order, "_position", slice_rows)
    page = F.floor(F.col("_position") / page_size).cast("long")
    return numbered.withColumn(into, page).drop("_position")
