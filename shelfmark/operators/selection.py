"""Choosing files: rule lists, and patterns that are themselves a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.patterns import FileRules

# Lengths of the text pieces that pattern tables are matched through: a pattern
# uses the longest that fits it, as long pieces are rare ones.
PIECES = (6, 3, 2, 1)
# Rows and cells of the sketch of their frequency, and how many paths stand behind one that is counted.
_ROWS, _WIDTH, _SKETCHED = 2, 1 << 16, 8


def select_files(objects: DataFrame, rules: FileRules) -> DataFrame:
    """Files that pass the rules; one predicate, pushed as far as Catalyst can."""
    predicate = rules.predicate(F.col("path"), F.col("label"))
    if "type" in objects.columns:
        predicate = (F.col("type") == "file") & predicate
    return objects.filter(predicate)


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second).distinct()


def difference(included: DataFrame, excluded: DataFrame, on: str = "path") -> DataFrame:
    return included.join(excluded.select(on).distinct(), on, "left_anti")


def match_pattern_table(
    paths: DataFrame, patterns: DataFrame, path: str = "path", pattern: str = "pattern"
) -> DataFrame:
    """Rows of ``paths`` that contain any of the patterns, ignoring case.

    A pattern is looked up through the rarest of its pieces of text, by
    equality, so no path meets every pattern.  How rare a piece is comes from a
    count-min sketch of the pieces of one path in eight, a table of fixed size,
    so that each path then emits only the pieces that some pattern is looked up
    by.  An empty pattern is in every path that is not null.
    """
    size = reduce(lambda case, n: case.when(F.length("_pattern") >= n, n), PIECES, F).otherwise(0)
    wanted = (
        patterns.select(F.lower(F.col(pattern)).alias("_pattern"))
        .filter(F.col("_pattern").isNotNull())
        .distinct()
        .withColumn("_size", size)
    )
    own = wanted.select("_pattern", F.explode(_pieces(F.col("_pattern"), F.col("_size"))).alias("_piece"))
    # Paths are cut at the lengths the patterns use, one small array.
    used = wanted.agg(F.collect_set("_size")).scalar()
    texts = paths.select(F.lower(F.col(path)).alias("_path")).filter(F.col("_path").isNotNull()).distinct()
    texts = texts.withColumn("_key", F.xxhash64("_path"))
    none = F.array().cast("array<string>")
    cut = F.concat(*[F.when(F.array_contains(used, n), _pieces(F.col("_path"), F.lit(n))).otherwise(none) for n in (*PIECES, 0)])
    # Common pieces, such as those of a shared path prefix, would pair a pattern with most paths.
    sample = texts.filter(F.pmod("_key", F.lit(_SKETCHED)) == 0).select(F.explode(cut).alias("_piece"))
    cells = sample.select(F.explode(_cells(F.col("_piece"))).alias("_cell")).groupBy("_cell")
    sketch = cells.agg(F.count(F.lit(1)).alias("_paths"))
    guess = own.select("_pattern", "_piece", F.explode(_cells(F.col("_piece"))).alias("_cell")).join(sketch, "_cell", "left")
    guess = guess.groupBy("_pattern", "_piece").agg(F.min(F.coalesce("_paths", F.lit(0))).alias("_paths"))
    anchors = guess.groupBy("_pattern").agg(F.min_by("_piece", F.struct("_paths", "_piece")).alias("_piece"))
    offered = texts.select("_key", F.explode(cut).alias("_piece"))
    pairs = offered.join(anchors, "_piece").select("_key", "_pattern")
    hits = texts.join(pairs, "_key").filter(F.contains("_path", "_pattern")).select("_path").distinct()
    return paths.join(hits, F.lower(paths[path]) == hits["_path"], "left_semi")


def _cells(piece: Column) -> Column:
    """The cell of a piece in each row of the sketch."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(row), piece), F.lit(_WIDTH)) + row * _WIDTH for row in range(_ROWS)])


def _pieces(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` characters; none when the text is shorter, the empty one for 0."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    cut = F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, size)))
    none = F.array().cast("array<string>")
    return F.when(size == 0, F.array(F.lit(""))).when(F.length(text) >= size, cut).otherwise(none)
