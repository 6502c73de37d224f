"""Checksums against a manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ("ok", "mismatch", "unexpected", "missing", "duplicate")


def verify_checksums(
    actual: DataFrame, manifest: DataFrame, within: Sequence[str] = ()
) -> DataFrame:
    """One row per name with its status.

    ``actual`` has ``label, md5``; ``manifest`` has ``name, checksum``.  Columns
    in ``within`` (a parent path, say) are part of the key on both sides.
    ``duplicate`` marks a name that either side lists twice.

    Both sides are stacked and grouped once instead of joined: one shuffle, and
    copies of a hot name are combined before it.
    """
    mine = actual.select(
        *within, F.col("label").alias("name"), F.col("md5").alias("have"),
        F.lit(None).cast("string").alias("want"), F.lit(1).alias("n_have"), F.lit(0).alias("n_want"),
    )
    theirs = manifest.select(
        *within, "name", F.lit(None).cast("string").alias("have"),
        F.col("checksum").alias("want"), F.lit(0).alias("n_have"), F.lit(1).alias("n_want"),
    )
    grouped = mine.unionByName(theirs).groupBy(*within, "name").agg(
        F.max("have").alias("actual"),
        F.max("want").alias("expected"),
        F.sum("n_have").alias("n_have"),
        F.sum("n_want").alias("n_want"),
    )
    status = (
        F.when((F.col("n_have") > 1) | (F.col("n_want") > 1), F.lit("duplicate"))
        .when(F.col("n_want") == 0, F.lit("unexpected"))
        .when(F.col("n_have") == 0, F.lit("missing"))
        .when(F.col("actual") == F.col("expected"), F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )
    return grouped.select(*within, "name", "actual", "expected", status.alias("status"))


def checksum_summary(verified: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Counts per status and the verdict: every name must be ``ok``."""
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES]
    return verified.groupBy(*within).agg(
        *counts, (F.count_if(F.col("status") != "ok") == 0).alias("passed")
    )
