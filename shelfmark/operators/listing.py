"""Listing directories and creating them.

A catalog has one row per path: ``path, label, parent, type, id, md5, size``
with ``type`` either ``file`` or ``dir``.  Keep it clustered by ``parent``: every
listing filters or joins on that stored column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.paths import label_of, normalize_path, parent_of
from shelfmark.operators.ranks import RANGE_ROWS, pages_within

PAGE_SIZE = 1000


def with_path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``label`` and ``parent``, taken from the normalised path."""
    bare = normalize_path(F.col(path))
    return df.withColumn("label", label_of(bare)).withColumn("parent", parent_of(bare))


def of_type(objects: DataFrame, kind: str) -> DataFrame:
    if kind not in ("dir", "file"):
        raise ValueError("type must be 'dir' or 'file'")
    return objects.filter(F.col("type") == kind)


def children(objects: DataFrame, path: str) -> DataFrame:
    """Every direct child of one directory."""
    return objects.filter(F.col("parent") == normalize_path(F.lit(path)))


def list_directory(
    objects: DataFrame, path: str, limit: int | None = None, strict: bool = False
) -> DataFrame:
    """All children of a directory, or its first ``limit`` by label.

    A path that has neither children nor a directory's row gives one row with
    status ``invalid_path``, or fails the job when ``strict``.
    """
    target = normalize_path(F.lit(path))
    entries = children(objects, path).withColumn("status", F.lit("ok"))
    if limit is not None:
        entries = entries.orderBy("label", "path").limit(limit)
    known = objects.filter(((F.col("path") == target) & (F.col("type") == "dir")) | (F.col("parent") == target))
    status = F.lit("invalid_path")
    if strict:
        status = F.raise_error(F.concat(F.lit("no such directory: "), target)).cast("string")
    absent = known.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        target.alias("path"),
        *[F.lit(None).cast(objects.schema[c].dataType).alias(c) for c in objects.columns if c != "path"],
        status.alias("status"),
    )
    return entries.unionByName(absent)


def list_files(objects: DataFrame, path: str, limit: int | None = None) -> DataFrame:
    found = of_type(children(objects, path), "file")
    return found if limit is None else found.orderBy("label", "path").limit(limit)


def list_folders(objects: DataFrame, path: str, limit: int | None = None) -> DataFrame:
    found = of_type(children(objects, path), "dir")
    return found if limit is None else found.orderBy("label", "path").limit(limit)


def list_many(requests: DataFrame, objects: DataFrame, ordinal: str = "ord") -> DataFrame:
    """List many directories at once: one row per request and entry.

    A directory without entries keeps one row with status ``empty``, anything
    else that is no directory one with ``invalid_path``.  Inner and anti joins
    rather than one outer join, because AQE can split a hot directory only there.
    """
    asked = requests.select(ordinal, normalize_path(F.col("path")).alias("directory"))
    entries = objects.select(
        F.col("parent").alias("directory"), F.col("label"), F.col("type")
    )
    found = asked.join(entries, "directory").withColumn("status", F.lit("ok"))
    # Only directories that are asked for, so the rest of the catalog is not made distinct.
    parents = entries.select("directory").join(asked.select("directory").distinct(), "directory", "left_semi").distinct()
    dirs = of_type(objects, "dir").select(F.col("path").alias("directory"), F.lit(True).alias("is_dir"))
    childless = asked.join(parents, "directory", "left_anti").join(dirs, "directory", "left")
    bare = childless.select(
        "directory",
        ordinal,
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("string").alias("type"),
        F.when(F.col("is_dir"), F.lit("empty")).otherwise(F.lit("invalid_path")).alias("status"),
    )
    return found.unionByName(bare).select(ordinal, "directory", "label", "type", "status")


def list_targets(requests: DataFrame, objects: DataFrame, ordinal: str = "ord") -> tuple[DataFrame, DataFrame]:
    """``list_many`` without repetition: the status of each request, and the entries of each directory once.

    The first table has ``ordinal, directory, n_entries, status``, the second
    ``directory, label, type``; they join on ``directory``.
    """
    asked = requests.select(ordinal, normalize_path(F.col("path")).alias("directory"))
    wanted = asked.select("directory").distinct()
    entries = objects.select(F.col("parent").alias("directory"), "label", "type")
    entries = entries.join(wanted, "directory", "left_semi")
    counts = entries.groupBy("directory").agg(F.count(F.lit(1)).alias("_n"))
    dirs = of_type(objects, "dir").select(F.col("path").alias("directory"), F.lit(True).alias("_is_dir"))
    n = F.coalesce("_n", F.lit(0)).cast("long")
    status = F.when(n > 0, F.lit("ok")).when(F.col("_is_dir"), F.lit("empty")).otherwise(F.lit("invalid_path"))
    answers = asked.join(counts, "directory", "left").join(dirs, "directory", "left")
    return answers.select(ordinal, "directory", n.alias("n_entries"), status.alias("status")), entries


def nested_listing(
    objects: DataFrame, page_size: int = PAGE_SIZE, slice_rows: int = RANGE_ROWS
) -> DataFrame:
    """``files`` and ``folders`` arrays per directory, in pages of ``page_size``.

    A directory that fits a page is one row with ``page`` 0; a larger one goes
    on in further pages, so no row ever holds more than a page.
    """
    paged = pages_within(
        objects.select("parent", "label", "type"),
        ["parent"],
        ["label", "type"],
        page_size,
        range_rows=slice_rows,
    )

    def names(kind: str) -> Column:
        picked = F.when(F.col("type") == kind, F.col("label"))
        return F.sort_array(F.collect_list(picked))

    return paged.groupBy("parent", "page").agg(
        names("file").alias("files"), names("dir").alias("folders")
    )


def make_directories(objects: DataFrame, paths: DataFrame) -> DataFrame:
    """The catalog with the asked directories added; existing paths stay as they are."""
    asked = paths.select(normalize_path(F.col("path")).alias("path")).distinct()
    fresh = with_path_parts(asked.join(objects.select("path"), "path", "left_anti"))
    typed = {f.name: f.dataType for f in objects.schema.fields}
    values = {"path": F.col("path"), "label": F.col("label"), "parent": F.col("parent"), "type": F.lit("dir")}
    added = fresh.select(
        *[values.get(c, F.lit(None).cast(typed[c])).alias(c) for c in objects.columns]
    )
    return objects.unionByName(added)
