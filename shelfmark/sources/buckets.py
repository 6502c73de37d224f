"""Keyed tables in buckets: a change rewrites the buckets it touches and no others.

A table is stored in folders by a hash of its key.  Posting tags, sharing and
revoking act on each key alone, so the same operators that fold a whole table
can fold only the buckets of the keys that are posted: their rows are read,
changed and put in the place of the old ones by a dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import deleted, durable

BUCKETS = 256
_BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class BucketedTable:
    """A table at ``location``, by ``keys``; the number of buckets is fixed when it is written.

    One writer at a time.  A write that fails leaves the old rows of every bucket.
    """

    def __init__(self, spark: SparkSession, location: str, keys: Sequence[str], schema: str, buckets: int = BUCKETS):
        self.spark, self.location, self.keys = spark, location.rstrip("/"), list(keys)
        self.schema, self.buckets = schema, buckets

    def write(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of the whole table."""
        self._bucketed(rows).write.mode("overwrite").partitionBy(_BUCKET).parquet(self.location)

    def read(self) -> DataFrame:
        return self._all().drop(_BUCKET)

    def read_for(self, keys: DataFrame) -> DataFrame:
        """The rows in the buckets of ``keys``; the other folders are not opened."""
        return self._all().filter(F.col(_BUCKET).isin(self._touched(keys))).drop(_BUCKET)

    def change(self, keys: DataFrame, fold: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Apply ``fold`` to the buckets that hold any of ``keys``; returns which those were.

        ``fold`` takes the rows of these buckets and returns what they hold from
        now on; it may add rows of the keys, but of no others.
        """
        touched = self._touched(keys)
        if not touched:
            return []
        before = self._all().filter(F.col(_BUCKET).isin(touched))
        # Fixed before anything is replaced, as the rows come from the folders that go.
        after = durable(self._bucketed(fold(before.drop(_BUCKET))))
        held = [r[0] for r in after.select(_BUCKET).distinct().collect()]
        foreign = sorted(set(held) - set(touched))
        if foreign:
            raise ValueError(f"rows of keys that were not named, in buckets {foreign[:5]}")
        writer = after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_BUCKET).parquet(self.location)
        for number in set(touched) - set(held):
            deleted(self.spark, f"{self.location}/{_BUCKET}={number}")
        return touched

    def _all(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {_BUCKET} int").parquet(self.location)

    def _touched(self, keys: DataFrame) -> list[int]:
        """At most as many numbers as there are buckets."""
        return sorted(r[0] for r in keys.select(bucket_of(self.keys, self.buckets).alias(_BUCKET)).distinct().collect())

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        # By the whole key as well, so that a bucket with a hot part of the key is written by several tasks.
        placed = rows.withColumn(_BUCKET, bucket_of(self.keys, self.buckets))
        return placed.repartition(_BUCKET, F.pmod(F.xxhash64(*rows.columns), F.lit(4)))
