"""Copying a growing directory: each run moves only the files that are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.patterns import FileRules
from shelfmark.sources.arrivals import OVERLAP, Arrivals
from shelfmark.sources.store import append_new, open_store


def arrivals(spark: SparkSession, source: str, overlap: float = OVERLAP) -> DataFrame:
    """The stream of ``uri, path, label, size`` of the files directly in ``source``, by arrival."""
    spark.dataSource.register(Arrivals)
    return spark.readStream.format(Arrivals.name()).option("directory", source).option("overlap", str(overlap)).load()


def incremental_copy(
    spark: SparkSession,
    source: str,
    store: str,
    dest: str,
    checkpoint: str,
    rules: FileRules | None = None,
) -> None:
    """Copy what arrived directly in ``source`` since the last run, then stop.

    The stream carries names and sizes only; content is read after the skip.  A
    batch that is replayed after a failure, or a file that is shown again, finds
    its name in the store.
    """
    open_store(spark, store)
    listing = arrivals(spark, source)
    if rules is not None:
        listing = listing.filter(rules.predicate(F.col("path"), F.col("label")))

    def copy(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, store, dest)

    query = (
        listing.writeStream.foreachBatch(copy)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
