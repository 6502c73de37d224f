"""A stream of the files that arrive in a folder.

An offset is a time, and a batch the files whose time of arrival lies between two
of them.  Nothing remembers names: not the driver, which asks only for the time,
and not the checkpoint.  Each batch is listed by several tasks, a slice of names
each.  Batches reach back over ``overlap`` seconds, for file systems with another
clock or coarse times, so a file may be shown twice; who copies skips it by name.
Empty files and names with a leading dot or underscore are files like others.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from shelfmark.sources.files import LISTING_SCHEMA, SLICE_BYTES, folder_entries, listing_slices, open_filesystem

OVERLAP = 600.0
# Longer than the tick by which file systems stamp: what is stamped up to an offset can be seen after it.
_SETTLES = 0.05


class Arrivals(DataSource):
    """Option ``directory``; ``overlap`` in seconds and ``sliceBytes`` may be given."""

    @classmethod
    def name(cls) -> str:
        return "arrivals"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _ArrivalReader(
            self.options["directory"],
            int(float(self.options.get("overlap", OVERLAP)) * 1e9),
            int(self.options.get("sliceBytes", SLICE_BYTES)),
        )


@dataclass
class _Slice(InputPartition):
    own: int
    slices: int
    after: int
    until: int


class _ArrivalReader(DataSourceStreamReader):
    def __init__(self, directory: str, overlap: int, slice_bytes: int):
        self.directory = directory
        self.overlap = overlap
        self.slice_bytes = slice_bytes

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        now = time.time_ns()
        time.sleep(_SETTLES)
        return {"until": now}

    def partitions(self, start: dict, end: dict) -> list[_Slice]:
        slices = listing_slices(self.directory, self.slice_bytes)
        after = max(0, start["until"] - self.overlap)
        return [_Slice(own, slices, after, end["until"]) for own in range(slices)]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        filesystem, path = open_filesystem(self.directory)
        prefix = self.directory.rstrip("/")[: -len(path.rstrip("/"))]
        for found, size, arrived in folder_entries(filesystem, path, partition.own, partition.slices):
            if partition.after < arrived <= partition.until or (arrived <= 0 and not partition.after):
                yield prefix + found, found, found.rpartition("/")[2], size

    def commit(self, end: dict) -> None:
        """There is nothing to forget."""
