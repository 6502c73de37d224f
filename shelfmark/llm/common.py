"""Helpers shared by the operators: tables, scratch copies, blocks of hot groups, components."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: one fixed copy, no lineage."""
    return _stored_at(df, scratch_path(df.sparkSession, name))


# Where set, the list that gets the folder of every scratch table.
_recorder: ContextVar[list[str] | None] = ContextVar("recorder", default=None)


@contextmanager
def recorded(folders: list[str]) -> Iterator[None]:
    """Note in ``folders`` what scratch tables are written meanwhile."""
    token = _recorder.set(folders)
    try:
        yield
    finally:
        _recorder.reset(token)


def _stored_at(df: DataFrame, path: str) -> DataFrame:
    if _recorder.get() is not None:
        _recorder.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shuffles_released(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished jobs.

    It does so when the driver's JVM collects its garbage, which with little on
    the driver happens too late for the executors' disks.
    """
    for _ in range(2):  # what the first round lets go of may hold others
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow``, in batches as large as the session says.

    For long texts ``spark.sql.execution.arrow.maxBytesPerBatch`` is the setting to
    lower; operators leave the session alone.
    """
    return df.mapInArrow(run, schema)


def ddl(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """The DDL of some columns of ``df``, for the schema of an Arrow map."""
    names = df.columns if columns is None else columns
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches with about ``most`` bytes of text each; one text is never split."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        at = np.cumsum(sizes, dtype=np.int64) // most
        cuts = np.flatnonzero(np.diff(at)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if end > start:
                yield batch.slice(start, end - start)


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int = 1
) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from a partition that is sorted by the keys.

    Short runs that follow each other come together until they have ``least`` rows or the
    batch ends.
    Only the current runs and batch are held.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for values in columns:
            new |= values[1:] != values[:-1]
        cuts = _spaced(np.flatnonzero(new) + 1, least)
        first = tuple(v[0] for v in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(bounds[:-2], bounds[1:-1]):
            held.append(batch.slice(start, end - start))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(bounds[-2], bounds[-1] - bounds[-2]))
        last = tuple(v[-1] for v in columns)
    if held:
        yield pa.Table.from_batches(held)


def _spaced(cuts: np.ndarray, least: int) -> np.ndarray:
    """Of ascending places those that lie at least so far from the one taken before, or from 0."""
    if least <= 1:
        return cuts
    taken, at = [], int(np.searchsorted(cuts, least))
    while at < len(cuts):
        taken.append(cuts[at])
        at = int(np.searchsorted(cuts, cuts[at] + least))
    return np.array(taken, np.int64)


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """A list column of equal lengths, or a fixed-size binary one, as a matrix."""
    rows = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_binary(column.type):
        flat = np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)
    else:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(rows, -1)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component_id`` of every node with an edge; the id is the smallest node reachable.

    Alternates two star steps: every node hands its larger neighbours to its
    smallest one, then its smaller neighbours.  Each step is a grouped minimum
    and an equi-join, so a hub is combined before the shuffle and its join can
    be split.  The edges are written out after each round, and those of the
    round before are deleted.  Null ends, loops and repeated edges change nothing.
    """
    big, small = F.greatest(a, b), F.least(a, b)
    links = edges.filter(F.col(a) != F.col(b)).select(big.alias("u"), small.alias("v")).distinct()
    spark, before = edges.sparkSession, None
    path = scratch_path(spark, "links")
    links = _stored_at(links, path)
    while True:
        state = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
            )
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch_path(spark, "links")
        links = _stored_at(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), new)
        removed(spark, path)
        path = new


def local_roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..count-1 and edges between them, the smallest node each one reaches."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
