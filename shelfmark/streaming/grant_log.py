"""Grants in force, kept up to date over a stream of changes.

The state is a log-structured table.  Each batch is a run: the last change of the
users and paths that it touched.  Every eighth batch merges the last eight runs
into one, every sixty-fourth the last eight of those, and so on, so a log of n
batches has about eight runs for each power of eight in n, and each change is
rewritten once for each.  A run's folder is named by its batches and counts once
Spark has marked it complete; of two that overlap the longer one does.  The stream
itself keeps no state.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.grants import GRANT_KEY, last_action
from shelfmark.session import deleted

STATE_SCHEMA = "usr bigint, path string, action string, permission string, ts timestamp_ntz, seq bigint"
FAN = 8


def follow_grants(changes: DataFrame, state: str, checkpoint: str, fan: int = FAN) -> None:
    """Fold every change that has arrived into the state table, then stop.

    The state belongs to the checkpoint, whose batches it counts.  A batch that
    is replayed replaces its run, or is left out where it has been merged.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        live, stale = runs(spark, state)
        for name in stale:
            deleted(spark, f"{state}/{name}")
        if any(first <= batch_id <= last and first < last for first, last in live):
            return
        _folded(batch).write.mode("overwrite").parquet(_folder(state, batch_id, batch_id))
        merge(spark, state, batch_id, fan)

    query = (
        changes.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merge(spark: SparkSession, state: str, batch_id: int, fan: int = FAN) -> None:
    """Merge the runs that batch ``batch_id`` completes, smaller ones first.

    Merged runs are deleted when the next batch begins, so that who reads the
    state meanwhile still finds them.
    """
    width = fan
    while (batch_id + 1) % width == 0:
        low = batch_id + 1 - width
        parts = [(first, last) for first, last in runs(spark, state)[0] if low <= first and last <= batch_id]
        if len(parts) > 1:
            rows = _read(spark, state, parts)
            _folded(rows).write.mode("overwrite").parquet(_folder(state, low, batch_id))
        width *= fan


def runs(spark: SparkSession, state: str) -> tuple[list[tuple[int, int]], list[str]]:
    """First and last batch of the runs that count, and the folders that do not any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(state)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return [], []
    found = {}
    for status in files.listStatus(root):
        named = re.fullmatch(r"run-(\d+)-(\d+)", status.getPath().getName())
        if named and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[int(named[1]), int(named[2])] = named[0]
    live = [
        (first, last)
        for first, last in sorted(found)
        if not any(a <= first and last <= b and (a, b) != (first, last) for a, b in found)
    ]
    return live, [name for run, name in found.items() if run not in live]


def followed_grants(spark: SparkSession, state: str) -> DataFrame:
    """What the state table says is in force: the last change of each user and path."""
    rows = _folded(_read(spark, state, runs(spark, state)[0]))
    return rows.filter(F.col("action") == "share").select(*GRANT_KEY, "permission")


def _folder(state: str, first: int, last: int) -> str:
    return f"{state}/run-{first}-{last}"


def _read(spark: SparkSession, state: str, parts: list[tuple[int, int]]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(*[_folder(state, *part) for part in parts])


def _folded(changes: DataFrame) -> DataFrame:
    latest = changes.groupBy(*GRANT_KEY).agg(
        last_action().alias("_last"), F.max(F.struct("ts", "seq")).alias("_at")
    )
    return latest.select(*GRANT_KEY, "_last.*", "_at.*")
