"""Directories of files as DataFrames, listed and read by tasks.

The built-in ``binaryFile`` source is not used for batch reads: it leaves out
empty files and names that start with a dot or an underscore, lists on the
driver, and loads every file whole, also those a later join would skip.
"""

from __future__ import annotations

import hashlib
import os
import stat
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.paths import label_of
from shelfmark.functions.patterns import FileRules

CHUNK_BYTES = 4 << 20
# File bytes one read task should handle.
TASK_BYTES = 1 << 30

LISTING_SCHEMA = "uri string, path string, label string, size bigint"
_LISTING_ROWS = 10_000
# Bytes of a folder's own directory file for each task that lists it, some 10,000 names.
SLICE_BYTES = 1 << 19
_SLICES_A_CORE = 4


def list_local_files(
    spark: SparkSession, source: str, rules: FileRules | None = None, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``uri, path, label, size`` of the files directly in ``source`` that pass the rules.

    ``source`` may also be one file, to which no rules apply.  No file is opened.
    A local or mounted folder is listed by several tasks: one streams the names,
    which is cheap, and deals them by hash to those that look them up, so no name
    is read twice.  Slices of fewer than ``SLICE_BYTES`` make no more than
    ``_SLICES_A_CORE`` tasks a core.
    A file that goes meanwhile is left out.  Other file systems have no such
    listing in Arrow, and are listed by one task.
    """
    filesystem, path = open_filesystem(source)
    kind = filesystem.get_file_info(path).type
    if kind == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(source)
    single = kind == arrow_fs.FileType.File
    slices = 1 if single else listing_slices(source, slice_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                yield from _listing(source, single)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _listed_in_batches(source, _looked_up(path, batch.column(0).to_pylist()))

    one = spark.range(0, 1, 1, 1)
    if slices == 1:
        found = one.mapInArrow(run, LISTING_SCHEMA)
    else:
        few = max(listing_slices(source), _SLICES_A_CORE * spark.sparkContext.defaultParallelism)
        names = one.mapInArrow(_names(source), "name binary")
        found = names.repartition(min(slices, few), "name").mapInArrow(look_up, LISTING_SCHEMA)
    if rules is None or single:
        return found
    return found.filter(rules.predicate(F.col("path"), F.col("label")))


def listing_slices(folder: str, slice_bytes: int = SLICE_BYTES) -> int:
    """How many tasks should list a folder, by the size of its directory file."""
    filesystem, path = open_filesystem(folder)
    if not isinstance(filesystem, arrow_fs.LocalFileSystem):
        return 1
    return max(1, -(-os.stat(path).st_size // slice_bytes))


def _listing(source: str, single: bool) -> Iterator[pa.RecordBatch]:
    filesystem, path = open_filesystem(source)
    if single:
        entries = iter([(path, filesystem.get_file_info(path).size, 0)])
    else:
        entries = folder_entries(filesystem, path)
    return _listed_in_batches(source, entries)


def _listed_in_batches(source: str, entries: Iterator[tuple[str, int, int]]) -> Iterator[pa.RecordBatch]:
    _, path = open_filesystem(source)
    prefix = source.rstrip("/")[: -len(path.rstrip("/"))]
    while some := list(islice(entries, _LISTING_ROWS)):
        paths, sizes, _ = zip(*some)
        yield _listed(prefix, paths, sizes)


def _names(folder: str):
    """The names in a local folder, of whatever they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, path = open_filesystem(folder)
        for batch in batches:
            for _ in range(batch.num_rows):
                with os.scandir(path) as entries:
                    while some := [os.fsencode(entry.name) for entry in islice(entries, _LISTING_ROWS)]:
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["name"])

    return run


def _looked_up(path: str, names: Iterable[bytes]) -> Iterator[tuple[str, int, int]]:
    """Path, size and time of arrival, as ``folder_entries`` has them, of those names that are files."""
    for name in names:
        found_at = f"{path.rstrip('/')}/{os.fsdecode(name)}"
        try:
            found = os.stat(found_at)
        except FileNotFoundError:
            continue
        if stat.S_ISREG(found.st_mode):
            yield found_at, found.st_size, found.st_ctime_ns


def _listed(prefix: str, paths: Sequence[str], sizes: Sequence[int]) -> pa.RecordBatch:
    labels = [path.rpartition("/")[2] for path in paths]
    uris = [prefix + path for path in paths]
    columns = [pa.array(values, pa.string()) for values in (uris, paths, labels)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], names=["uri", "path", "label", "size"])


def folder_entries(filesystem, path: str, own: int = 0, slices: int = 1) -> Iterator[tuple[str, int, int]]:
    """Path, size and time of arrival, in nanoseconds, of the files of one slice of a folder.

    A local file arrives when its inode changes, which a rename does too; elsewhere
    it is the time it was last written.
    """
    if not isinstance(filesystem, arrow_fs.LocalFileSystem):
        for info in filesystem.get_file_info(arrow_fs.FileSelector(path)):
            if info.type == arrow_fs.FileType.File:
                yield info.path, info.size, info.mtime_ns or 0
        return
    with os.scandir(path) as entries:
        for entry in entries:
            if slices > 1 and zlib.crc32(os.fsencode(entry.name)) % slices != own:
                continue
            try:
                if entry.is_file():
                    found = entry.stat()
                    yield f"{path.rstrip('/')}/{entry.name}", found.st_size, found.st_ctime_ns
            except FileNotFoundError:
                continue


def open_filesystem(uri: str):
    """The Arrow filesystem and path of a URI or a plain absolute path."""
    if uri.startswith("/"):
        return arrow_fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    # Only the root is parsed as a URI: names may hold spaces, '%' and '#'.
    scheme, _, rest = uri.replace("s3a://", "s3://", 1).partition("://")
    authority, _, name = rest.partition("/")
    filesystem, root = arrow_fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return filesystem, f"{root.rstrip('/')}/{name}"


def describe(files: DataFrame) -> DataFrame:
    """Listing rows of a ``binaryFile`` scan's ``path, length``."""
    plain = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return files.select(
        F.col("path").alias("uri"),
        plain.alias("path"),
        label_of(plain).alias("label"),
        F.col("length").cast("long").alias("size"),
    )


def spread_by_bytes(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows of ``files`` over enough tasks that each reads about ``task_bytes``.

    The listing itself is tiny, so without this AQE would put it in one task.
    Files of a quarter of that and more are dealt out by themselves, as many to
    a task as make up its share, so that no two of the largest meet in one.
    """
    large = F.col("size") >= task_bytes // 4
    total, count, large_count, most = files.agg(
        F.sum(F.when(~large, F.col("size"))),
        F.count_if(~large),
        F.count_if(large),
        F.max("size"),
    ).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    small = files.filter(~large | F.col("size").isNull())
    small = small.repartition(max(1, min(count, max(-(-(total or 0) // task_bytes), cores))))
    if not large_count:
        return small
    each = max(1, task_bytes // most)  # files of the largest size that one task reads
    tasks = max(-(-large_count // each), min(large_count, cores))
    dealt = files.filter(large).repartition(tasks)
    return dealt if not count else small.unionByName(dealt)


def file_digests(files: DataFrame) -> DataFrame:
    """``path, label, size, md5`` of the listed files; content stays in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for uri in batch.column("uri").to_pylist():
                for _, _, md5, _ in _chunks(uri, CHUNK_BYTES):
                    pass
                digests.append(md5)
            kept = [batch.column(name) for name in ("path", "label", "size")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(digests, pa.string())], names=["path", "label", "size", "md5"])

    return spread_by_bytes(files).mapInArrow(run, "path string, label string, size bigint, md5 string")


def read_chunks(files: DataFrame, chunk_bytes: int | None = CHUNK_BYTES) -> DataFrame:
    """The bytes of the listed files, one row per chunk; null means whole files.

    Adds ``part`` from 0 up, ``content``, and ``md5``, which is the digest of
    the whole file on its last chunk and null before.  Where ``files`` has a
    ``size``, the last chunk has the bytes that were read, as a file may have
    grown since it was listed.  Only listed files are opened, and a task holds
    about a chunk at a time.
    """
    batch_bytes = chunk_bytes or CHUNK_BYTES
    uri_at = files.columns.index("uri")
    names = [*files.columns, "part", "content", "md5"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, chunks, held = [], [], 0
            for row in range(batch.num_rows):
                for chunk in _chunks(batch.column(uri_at)[row].as_py(), chunk_bytes):
                    rows.append(row)
                    chunks.append(chunk)
                    held += len(chunk[1])
                    if held >= batch_bytes:
                        yield _with_chunks(batch, rows, chunks, names)
                        rows, chunks, held = [], [], 0
            if rows:
                yield _with_chunks(batch, rows, chunks, names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields]
    return files.mapInArrow(run, ", ".join([*fields, "part bigint", "content binary", "md5 string"]))


def _with_chunks(batch: pa.RecordBatch, rows: list, chunks: list, names: list) -> pa.RecordBatch:
    parts, contents, digests, ends = zip(*chunks)
    kept = batch.take(pa.array(rows)).columns
    if "size" in names:
        at = names.index("size")
        kept[at] = pc.coalesce(pa.array(ends, kept[at].type), kept[at])
    added = [pa.array(parts, pa.int64()), pa.array(contents, pa.binary()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays([*kept, *added], names=names)


def _chunks(uri: str, chunk_bytes: int | None) -> Iterator[tuple[int, bytes, str | None, int | None]]:
    """Number, bytes, and on the last chunk digest and size of the file."""
    filesystem, path = open_filesystem(uri)
    digest = hashlib.md5(usedforsecurity=False)
    with filesystem.open_input_stream(path) as stream:
        part, content, size = 0, stream.read(chunk_bytes), 0
        while True:
            digest.update(content)
            size += len(content)
            following = stream.read(chunk_bytes) if len(content) == chunk_bytes else b""
            yield part, content, *((None, None) if following else (digest.hexdigest(), size))
            if not following:
                return
            part, content = part + 1, following
