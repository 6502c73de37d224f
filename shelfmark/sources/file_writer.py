"""A Spark data source that writes rows as files.

``binaryFile`` only reads.  Each task writes into a folder of its job below the
target and moves a file out of it when it is complete, so retried and speculative
tasks leave whole files only.  The folder goes when the job ends; listings, which
do not descend, never show what a killed job left in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from shelfmark.sources.files import open_filesystem


@dataclass
class _Written(WriterCommitMessage):
    files: int


class FileTreeSink(DataSource):
    """Rows of ``name, part, content, last``; option ``directory`` is the target."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _FileTreeWriter(self.options["directory"], overwrite)


class _FileTreeWriter(DataSourceArrowWriter):
    def __init__(self, directory: str, overwrite: bool):
        self.directory = directory
        self.overwrite = overwrite
        self.staging = f".writing-{uuid.uuid4().hex}"

    def commit(self, messages: list) -> None:
        self._clean()

    def abort(self, messages: list) -> None:
        self._clean()

    def _clean(self) -> None:
        filesystem, root = open_filesystem(self.directory)
        staging = f"{root}/{self.staging}"
        if filesystem.get_file_info(staging).type == fs.FileType.Directory:
            filesystem.delete_dir(staging)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, root = open_filesystem(self.directory)
        staging = f"{root}/{self.staging}"
        filesystem.create_dir(staging, recursive=True)
        written, target = 0, None
        try:
            for batch in iterator:
                columns = [batch.column(c) for c in ("name", "content", "last")]
                for name, content, last in zip(*columns):
                    if target is None:
                        target = _Target(filesystem, f"{root}/{name.as_py()}", staging, self.overwrite)
                    target.add(content.as_buffer())
                    if last.as_py():
                        written += target.finish()
                        target = None
        finally:
            if target is not None:
                target.discard()
        return _Written(written)


class _Target:
    """One file being written; a file that exists is passed over."""

    def __init__(self, filesystem: fs.FileSystem, path: str, staging: str, overwrite: bool):
        self.filesystem, self.path = filesystem, path
        self.temporary = f"{staging}/{uuid.uuid4().hex}"
        there = not overwrite and filesystem.get_file_info(path).type != fs.FileType.NotFound
        self.stream = None if there else filesystem.open_output_stream(self.temporary)

    def add(self, content: pa.Buffer) -> None:
        if self.stream is not None:
            self.stream.write(content)

    def finish(self) -> int:
        if self.stream is None:
            return 0
        self.stream.close()
        self.filesystem.move(self.temporary, self.path)
        return 1

    def discard(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.filesystem.delete_file(self.temporary)
