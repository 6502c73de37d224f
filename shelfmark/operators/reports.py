"""Column jobs: storage use, text rewriting, response logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.python_kernels import strip_null_keys
from shelfmark.functions.responses import has_keys, path_entry, response_outcome
from shelfmark.functions.sizes import readable_bytes
from shelfmark.functions.text import replace_literal


def storage_usage(objects: DataFrame, by: str = "parent", symbols: str = "customary") -> DataFrame:
    """Files, bytes and readable size per directory."""
    files = objects.filter(F.col("type") == "file")
    total = files.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("size").alias("n_bytes"),
    )
    return total.withColumn("readable", readable_bytes(F.col("n_bytes"), symbols=symbols))


def rewrite_text(
    df: DataFrame, column: str, pattern: str, replacement: str, ignore_case: bool = False
) -> DataFrame:
    return df.withColumn(column, replace_literal(F.col(column), pattern, replacement, ignore_case))


def strip_nulls(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, strip_null_keys(F.col(column)))


def classify_responses(log: DataFrame) -> DataFrame:
    outcome = response_outcome(F.col("endpoint"), F.col("status"), F.col("body"))
    return log.withColumn("outcome", outcome)


def require_keys(log: DataFrame, keys: Sequence[str], nulls_count: bool = True) -> DataFrame:
    """Add ``complete``: the body has all the keys, by default also with null values."""
    return log.withColumn("complete", has_keys(F.col("body"), keys, nulls_count))


def extract_entry(log: DataFrame, path: str = "path") -> DataFrame:
    """Add ``exists``: the body's ``paths`` entry for the row's own path, false if absent."""
    found = path_entry(F.col("body"), F.col(path), T.BooleanType())
    return log.withColumn("exists", F.coalesce(found, F.lit(False)))
