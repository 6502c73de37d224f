"""Positions and pages from tables laid out in order: every row is evaluated and ranked once.

``numbering`` gives the same answers within one lazy plan, at the price of
evaluating its input three times.  Here the input is written out once, laid out
by ranges of (keys, order), and written again with the place of each row in its
range; what comes before a range is a small table of counts.  Ranges are cut
among all rows and equal rows are told apart by where they were first written,
so neither a hot group nor a run of equal rows bounds how finely they are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import deleted, scratch_path, written

# Rows of one range, which one task sorts; a small table is still dealt over the cores.
RANGE_ROWS = 250_000
_LEAST_ROWS = 5_000
# Ranges of fewer rows than this cost more than they spread.
_SMALLEST_RANGE = 250


def ranked_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    into: str = "ordinal",
    total: str | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in its group, and as ``total`` the rows of the group.

    Nulls come first, in keys and order, and a null key is a group of its own;
    without keys all rows are one group.  Rows that agree in all of ``order``
    come one after another in any order.  Runs jobs: the result reads a table in
    the shared folder.
    """
    spark = df.sparkSession
    first = scratch_path(spark, "rows")
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), first)
    # One range for so many rows, or for so few that another task would not pay.
    count = rows.count()
    cores = min(spark.sparkContext.defaultParallelism, -(-count // _LEAST_ROWS))
    ranges = max(1, -(-count // max(range_rows, _SMALLEST_RANGE)), cores)
    where = [*dict.fromkeys([*keys, *order]), "_row"]
    placed = rows.repartitionByRange(ranges, *where).sortWithinPartitions(*where)
    # The number of the range in the upper bits, and the place in it in the lower 33.
    at = F.monotonically_increasing_id().alias("_at")
    laid = written(placed.select(*df.columns, at), scratch_path(spark, "ranges"))
    deleted(spark, first)
    return _counted(laid, df.columns, keys, into, total)


def _counted(laid: DataFrame, columns: Sequence[str], keys: Sequence[str], into: str, total: str | None) -> DataFrame:
    names = [f"_key_{k}" for k in keys]
    same_group = Window.partitionBy(*names)
    heads = laid.groupBy(_range().alias("_range"), *[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_head")
    )
    earlier = F.sum("_rows").over(same_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = heads.select(
        "_range",
        *names,
        (F.coalesce(earlier, F.lit(0)) - F.col("_head")).alias("_shift"),
        F.sum("_rows").over(same_group).alias("_total"),
    )
    same = _range() == F.col("_range")
    for key, name in zip(keys, names):
        same = same & laid[key].eqNullSafe(shifts[name])
    added = [(F.col("_at") + F.col("_shift")).alias(into)]
    if total is not None:
        added.append(F.col("_total").alias(total))
    return laid.join(shifts, same).select(*[laid[c] for c in columns], *added)


def _range() -> Column:
    return F.shiftright("_at", 33)


def pages_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    page_size: int,
    into: str = "page",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add a 0-based page number, ``page_size`` rows of a group to a page."""
    if page_size < 1:
        raise ValueError("page_size must be 1 or more")
    ranked = ranked_within(df, keys, order, "_position", range_rows=range_rows)
    return ranked.withColumn(into, F.floor(F.col("_position") / page_size).cast("long")).drop("_position")
