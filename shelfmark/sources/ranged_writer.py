"""Files written in ranges by several tasks, and made visible by a second step.

The first step stages content below the target folder and returns a manifest, a
row for each range, which Spark commits to the shared folder: what a failed or
repeated attempt has staged is in no manifest.  On a local or mounted file
system the ranges of a file go to their place in one staged file; elsewhere each
is a piece, and the pieces are joined.  The second step runs only where every
file's ranges follow each other without a gap up to its last one.  It moves each
staged file to its name, so nothing is ever visible in part, and a repeated
task finds what is already moved.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import scratch_path, written
from shelfmark.sources.files import open_filesystem

_MANIFEST = "name string, offset bigint, length bigint, last boolean, staged string"
_COPY_BYTES = 4 << 20


class IncompleteFile(ValueError):
    """The ranges of a file do not make one whole file."""


def write_ranges(rows: DataFrame, directory: str, overwrite: bool = False) -> DataFrame:
    """Write ``name, offset, content, last`` rows as files in ``directory``; runs both steps.

    The rows may lie in any order and in any partitions; ``last`` marks the range
    that ends its file.  Returns ``name, size, ranges, published`` of each file:
    a name that is already there stays as it is unless ``overwrite``, with
    ``published`` false.  If ranges are missing or overlap, ``IncompleteFile`` is
    raised and no file appears.
    """
    spark = rows.sparkSession
    filesystem, root = open_filesystem(directory)
    staging = f"{root.rstrip('/')}/.writing-{uuid.uuid4().hex}"
    filesystem.create_dir(staging, recursive=True)
    picked = rows.select("name", F.col("offset").cast("long").alias("offset"), "content", "last")
    try:
        staged = picked.mapInArrow(_stager(directory, staging), _MANIFEST)
        manifest = written(staged, scratch_path(spark, "manifest"))
        files = written(_files(manifest), scratch_path(spark, "files"))
        wrong = [r.name for r in files.filter("not whole").limit(5).collect()]
        if wrong:
            raise IncompleteFile(f"ranges missing or repeated in {', '.join(wrong)}")
        moved = files.mapInArrow(_publisher(directory, staging, overwrite), "name string, size bigint, ranges bigint, published boolean")
        return written(moved, scratch_path(spark, "published"))
    finally:
        filesystem.delete_dir(staging)


def _files(manifest: DataFrame) -> DataFrame:
    """``name, size, ranges, whole, staged`` of each file of a manifest; its ranges are as many as its chunks."""
    ranges = F.sort_array(F.collect_list(F.struct("offset", "length", "last", "staged")))
    grouped = manifest.groupBy("name").agg(ranges.alias("found"))
    # Where the ranges follow each other this is the size, otherwise -1.
    size = F.aggregate(
        "found", F.lit(0).cast("long"), lambda at, r: F.when(r["offset"] == at, at + r["length"]).otherwise(F.lit(-1))
    )
    ends = F.size(F.filter("found", lambda r: r["last"]))
    whole = (size >= 0) & (ends == 1) & F.element_at("found", -1)["last"]
    return grouped.select(
        "name",
        size.alias("size"),
        F.size("found").cast("long").alias("ranges"),
        F.coalesce(whole, F.lit(False)).alias("whole"),
        F.array_distinct(F.transform("found", lambda r: r["staged"])).alias("staged"),
    )


def _stager(directory: str, staging: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = open_filesystem(directory)
        in_place = isinstance(filesystem, fs.LocalFileSystem)
        for batch in batches:
            lengths, places = [], []
            for name, offset, content, last in zip(*(batch.column(c) for c in ("name", "offset", "content", "last"))):
                data, at = content.as_buffer(), offset.as_py()
                if in_place and not (at == 0 and last.as_py()):
                    place = f"{staging}/f-{hashlib.sha256(name.as_py().encode()).hexdigest()}"
                    _put(place, data, at)
                else:
                    place = f"{staging}/p-{uuid.uuid4().hex}"
                    with filesystem.open_output_stream(place) as stream:
                        stream.write(data)
                lengths.append(len(data))
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("name"),
                    batch.column("offset"),
                    pa.array(lengths, pa.int64()),
                    batch.column("last"),
                    pa.array(places, pa.string()),
                ],
                names=["name", "offset", "length", "last", "staged"],
            )

    return run


def _put(path: str, data: pa.Buffer, at: int) -> None:
    """Write a range of a file that other tasks may be writing too; a repeat writes the same bytes."""
    handle = os.open(path, os.O_CREAT | os.O_WRONLY, 0o666)
    try:
        view = memoryview(data)
        while len(view):
            done = os.pwrite(handle, view, at)
            view, at = view[done:], at + done
    finally:
        os.close(handle)


def _publisher(directory: str, staging: str, overwrite: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = open_filesystem(directory)
        for batch in batches:
            published = [
                _publish(filesystem, pieces, f"{root.rstrip('/')}/{name}", staging, overwrite)
                for name, pieces in zip(batch.column("name").to_pylist(), batch.column("staged").to_pylist())
            ]
            kept = [batch.column(c) for c in ("name", "size", "ranges")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(published, pa.bool_())], names=["name", "size", "ranges", "published"])

    return run


def _publish(filesystem: fs.FileSystem, pieces: list[str], target: str, staging: str, overwrite: bool) -> bool:
    """Move the staged file to its name; a repeated attempt says what the first one said."""

    def there(path: str) -> bool:
        return filesystem.get_file_info(path).type != fs.FileType.NotFound

    if not there(pieces[0]):
        return True  # moved by an earlier attempt
    joining = f"{staging}/m-{hashlib.sha256(target.encode()).hexdigest()}"
    if not overwrite and there(target):
        return len(pieces) > 1 and there(joining)
    staged = pieces[0]
    if len(pieces) > 1:
        with filesystem.open_output_stream(joining):
            pass
        staged = f"{staging}/j-{uuid.uuid4().hex}"
        with filesystem.open_output_stream(staged) as out:
            for piece in pieces:
                with filesystem.open_input_stream(piece) as stream:
                    while data := stream.read(_COPY_BYTES):
                        out.write(data)
    filesystem.move(staged, target)
    return True
