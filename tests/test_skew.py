"""One directory, name, path or user holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import listing, lookup
from shelfmark.operators.grants import current_grants, share
from shelfmark.operators.integrity import verify_checksums
from shelfmark.operators.transfer import first_wins
from tests.conftest import HOME, plan_of, rows

ROWS = 300_000

# AQE thresholds scaled down to a table that fits a test.
SMALL = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
}


@pytest.fixture(scope="module")
def small_thresholds(spark):
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def catalog(spark, small_thresholds):
    parent = f"if(id % 3 = 0, '{HOME}/hot', concat('{HOME}/d', id % 5000))"
    return spark.range(0, ROWS, 1, 8).selectExpr(
        f"concat({parent}, '/f', id, '-', md5(cast(id as string))) as path",
        "concat('f', id, '-', md5(cast(id as string))) as label",
        f"{parent} as parent", "'file' as type", "cast(id as string) as id", "'x' as md5", "id as size",
    )


def final_plan(df):
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def test_a_hot_directory_is_split_when_listed_and_resolved(spark, catalog):
    dirs = spark.range(0, 50).selectExpr("id as rid", f"if(id = 0, '{HOME}/hot', concat('{HOME}/d', id)) as path")
    resolved = lookup.resolve_requests(dirs, catalog).groupBy("status").agg(F.count("rid").alias("count"), F.max("file"))
    listed = listing.list_many(dirs.withColumnRenamed("rid", "ord"), catalog).groupBy("status").agg(F.count("ord").alias("count"), F.max("label"))
    assert "SortMergeJoin(skew=true)" in final_plan(resolved)
    assert "SortMergeJoin(skew=true)" in final_plan(listed)
    hot = ROWS // 3
    want = hot + catalog.filter(f"parent rlike '/d([1-9]|[1-4][0-9])$'").count()
    assert rows(resolved.filter("status = 'ok'"), "count") == [(want,)]
    assert rows(listed.filter("status = 'ok'"), "count") == [(want,)]


def test_copies_of_a_hot_key_are_combined_before_the_shuffle(spark, catalog):
    readme = catalog.selectExpr("path", "if(size % 3 = 0, 'README', label) as label", "md5")
    manifest = readme.selectExpr("label as name", "md5 as checksum")
    verified = verify_checksums(readme, manifest)
    assert rows(verified.filter("name = 'README'"), "status") == [("duplicate",)]
    assert verified.filter("status = 'ok'").count() == ROWS - ROWS // 3
    log = spark.range(0, ROWS, 1, 8).selectExpr(
        "id as seq", "id as ts", "if(id % 3 = 0, 0, id) as usr", f"'{HOME}/p' as path", "'share' as action", "'read' as permission"
    )
    for df in (verified, first_wins(readme.select("path", "label")), current_grants(log),
               share(current_grants(log), log, HOME)):
        plan = plan_of(df)
        assert "partial_" in plan and "Window" not in plan
    assert first_wins(readme.select("path", "label")).count() == ROWS - ROWS // 3 + 1
    assert current_grants(log).count() == ROWS - ROWS // 3 + 1
