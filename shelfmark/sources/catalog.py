"""A stored catalog, laid out so that listings read little of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG_SCHEMA = (
    "path string, label string, parent string, type string, id string, md5 string, size bigint"
)
CATALOG_COLUMNS = ("path", "label", "parent", "type", "id", "md5", "size")


def write_catalog(objects: DataFrame, location: str) -> None:
    """Write the catalog in order of directory and path.

    Ranges rather than hashes of the directory: a large directory spreads over
    many files, and row-group statistics let a listing skip the others.
    """
    ordered = objects.select(*CATALOG_COLUMNS).repartitionByRange("parent", "path")
    ordered.sortWithinPartitions("parent", "path").write.mode("overwrite").parquet(location)


def write_lookup_catalog(objects: DataFrame, table: str, location: str, buckets: int) -> DataFrame:
    """Write the catalog as the table ``table``, bucketed and sorted by path.

    Joining requests to it by path moves and sorts only the requests, so a
    catalog that is looked up again and again is shuffled once, when written.
    """
    rows = objects.select(*CATALOG_COLUMNS)
    # As many tasks as buckets, and one file a bucket.
    placed = rows.repartition(buckets, "path")
    writer = placed.write.mode("overwrite").bucketBy(buckets, "path").sortBy("path").option("path", location)
    writer.saveAsTable(table)
    return objects.sparkSession.table(table)


def read_catalog(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(CATALOG_SCHEMA).parquet(location)
