"""The content table: file bytes as Parquet rows, and copies into and out of it.

One row per chunk: ``path, label, parent, size, part, content, md5``.  ``md5``
is set on the last chunk of a file only, so the rows that have it are the
catalog, and reading those touches no content.  Files of one chunk and of
several lie in separate partitions, ``chunked``, as only the latter have to be
put together again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.patterns import FileRules
from shelfmark.functions.paths import join_path, normalize_path
from shelfmark.operators.integrity import checksum_summary, verify_checksums
from shelfmark.operators.transfer import first_wins, plan_actions, skip_existing, transfer_ordinals
from shelfmark.session import durable
from shelfmark.sources.file_writer import FileTreeSink
from shelfmark.sources.files import (
    CHUNK_BYTES,
    TASK_BYTES,
    list_local_files,
    open_filesystem,
    read_chunks,
    spread_by_bytes,
)
from shelfmark.sources.ranged_writer import write_ranges

STORE_SCHEMA = (
    "path string, label string, parent string, size bigint, part bigint, content binary, md5 string, "
    "chunked boolean"
)
STORE_COLUMNS = ["path", "label", "parent", "size", "part", "content", "md5"]

# Bytes of content in a row group, which a task holds whole when it writes or reads one.  Left alone,
# Parquet first looks at sizes after 100 rows, and keeps the least and greatest content of each row group.
ROW_GROUP_BYTES = 4 * CHUNK_BYTES
_WRITE_OPTIONS = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.column.statistics.enabled#content": "false",
    "parquet.enable.dictionary#content": "false",
    "parquet.bloom.filter.enabled#label": "true",
    # As large as the labels need: each row group has a filter, held until the file is done.
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def open_store(spark: SparkSession, store: str) -> DataFrame:
    """The content table at ``store``, created empty if there is none."""
    nothing = spark.createDataFrame([], STORE_SCHEMA)
    nothing.write.mode("ignore").partitionBy("chunked").parquet(store)
    return spark.read.schema(STORE_SCHEMA).parquet(store)


def stored_files(content: DataFrame) -> DataFrame:
    """Catalog rows of the files in a content table."""
    return content.filter(F.col("md5").isNotNull()).select(
        "path",
        "label",
        "parent",
        F.lit("file").alias("type"),
        F.lit(None).cast("string").alias("id"),
        "md5",
        "size",
    )


# So many names go to the scan itself, which then opens only row groups that may hold one.
PUSHED_NAMES = 1000


def only_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """The rows whose ``label`` is in ``names(label)``; a few names are pushed down to the files."""
    few = names.select("label").distinct().limit(PUSHED_NAMES + 1).collect()
    if len(few) > PUSHED_NAMES:
        return rows.join(names.select("label").distinct(), "label", "left_semi")
    return rows.filter(F.col("label").isin([r.label for r in few]))


class CopyReport(NamedTuple):
    """How many names a copy wrote and how many it passed over."""

    copied: int
    skipped: int


def append_new(listing: DataFrame, store: str, dest: str, chunk_bytes: int = CHUNK_BYTES) -> CopyReport:
    """Copy the listed files flat into ``dest``; names already there are skipped.

    Of several sources with one name the first by path is kept.  The skip is
    decided from names alone, before any file is opened, so a repeated or
    retried run appends only what is missing.
    """
    spark = listing.sparkSession
    parent = normalize_path(F.lit(dest))
    # Fixed before the copy, so that a recomputed task reads the very same files.
    wanted = durable(first_wins(listing))
    there = only_names(stored_files(open_store(spark, store)).filter(F.col("parent") == parent), wanted)
    todo = durable(skip_existing(wanted, there))
    sets = {"false": todo.filter(F.col("size") <= chunk_bytes), "true": todo.filter(F.col("size") > chunk_bytes)}
    for chunked, files in sets.items():
        count, total = files.agg(F.count("label"), F.sum("size")).first()
        if not count:
            continue
        # By what is read, not by what was listed: a file that has grown since is cut as well.
        chunks = read_chunks(spread_by_bytes(files), chunk_bytes)
        rows = chunks.withColumn("parent", parent).withColumn("path", join_path(parent, F.col("label")))
        # Content that compresses well fills a row group with rows long before it does with bytes.
        row_bytes = max(1, min(chunk_bytes, total // count))
        limit = {"parquet.block.row.count.limit": str(max(1, ROW_GROUP_BYTES // row_bytes))}
        rows = rows.select(*STORE_COLUMNS).write.mode("append").options(**_WRITE_OPTIONS, **limit)
        rows.parquet(f"{store}/chunked={chunked}")
    copied = todo.count()
    return CopyReport(copied, wanted.count() - copied)


def ingest_directory(
    spark: SparkSession, source: str, store: str, dest: str, rules: FileRules | None = None
) -> CopyReport:
    """Copy a file, or the files of a directory that pass the rules, into ``dest``."""
    return append_new(list_local_files(spark, source, rules), store, dest)


def plan_export(
    files: DataFrame, existing: DataFrame, overwrite: bool = False, manifest: DataFrame | None = None
) -> DataFrame:
    """What a copy out of the store would do: one row per target name.

    Adds ``ordinal`` within the source directory, ``action``, and with a
    ``manifest`` the checksum ``status`` of each file.
    """
    plan = plan_actions(transfer_ordinals(first_wins(files)), existing, overwrite=overwrite)
    if manifest is None:
        return plan
    checked = verify_checksums(files, manifest).select(F.col("name").alias("label"), "status")
    return plan.join(checked, "label", "left")


def export_rows(rows: DataFrame, directory: str, overwrite: bool = False) -> None:
    """Write ``name, part, content, last`` rows as files in ``directory``.

    The chunks of a file must be in one partition and in order.  A name that is
    already there is skipped unless ``overwrite``; the tasks look that up
    themselves, so content is never shuffled to be joined with a listing.
    """
    for session in {rows.sparkSession, SparkSession.active()}:  # Spark looks it up in the active one
        session.dataSource.register(FileTreeSink)
    mode = "overwrite" if overwrite else "append"
    rows.select("name", "part", "content", "last").write.format(FileTreeSink.name()).mode(mode).option(
        "directory", directory
    ).save()


def export_directory(
    spark: SparkSession,
    store: str,
    from_path: str,
    directory: str,
    rules: FileRules | None = None,
    manifest: DataFrame | None = None,
    overwrite: bool = False,
) -> CopyReport:
    """Copy the stored files directly under ``from_path`` that pass the rules.

    ``from_path`` may also be one file, to which no rules apply.  A manifest is
    checked against the directory before anything is written.  It is an error if
    the path does not exist, and another if nothing there passes the rules.
    Taken names are found from listings, and only content that will be written is
    read; it may lie in any order, as each chunk is written to its own place.
    """
    source = normalize_path(F.lit(from_path))
    below, itself = F.col("parent") == source, F.col("path") == source
    content = open_store(spark, store).filter(below | itself)
    if manifest is not None:
        checked = verify_checksums(stored_files(content), manifest)
        if not checksum_summary(checked).first()["passed"]:
            raise ValueError(f"checksums of {from_path} do not match the manifest")
    if stored_files(content).isEmpty():
        raise FileNotFoundError(f"no such path in the store: {from_path}")
    if rules is not None:
        content = content.filter(itself | rules.predicate(F.col("path"), F.col("label")))
    if stored_files(content).isEmpty():
        raise ValueError(f"nothing selected at {from_path}")
    wanted = stored_files(content).select("label").distinct()
    todo = wanted if overwrite else durable(skip_existing(wanted, _names_in(spark, directory)))
    copied, total = todo.count(), wanted.count()
    if copied:
        write_ranges(ranges_of(content if copied == total else only_names(content, todo)), directory, overwrite)
    return CopyReport(copied, total - copied)


def ranges_of(content: DataFrame, task_bytes: int = TASK_BYTES // 64) -> DataFrame:
    """``name, offset, content, last`` of content rows; the chunks of large files are dealt over tasks.

    All chunks of a file but the last are of one length, so each knows its place.
    Files of one chunk are written where they are read.
    """
    last = F.col("md5").isNotNull()
    offset = F.when(last, F.col("size") - F.length("content")).otherwise(F.col("part") * F.length("content"))
    rows = content.select(F.col("label").alias("name"), offset.alias("offset"), "content", last.alias("last"), "chunked", "part")
    small = rows.filter(~F.col("chunked")).drop("chunked", "part")
    chunked = content.filter("chunked")
    chunks, total = chunked.agg(F.count("part"), F.sum(F.when(last, F.col("size")))).first()
    if not chunks:
        return small
    cores = content.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(chunks, max(-(-(total or 0) // task_bytes), cores)))
    large = rows.filter("chunked").repartition(tasks, "name", "part").drop("chunked", "part")
    return small.unionByName(large)


def _names_in(spark: SparkSession, directory: str) -> DataFrame:
    """``label`` of the files directly in a directory; none when there is no directory."""
    filesystem, path = open_filesystem(directory)
    if filesystem.get_file_info(path).type == FileType.NotFound:
        return spark.createDataFrame([], "label string")
    return list_local_files(spark, directory).select("label")
