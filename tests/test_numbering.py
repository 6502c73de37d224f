import random

import pytest

from shelfmark.operators.listing import nested_listing
from shelfmark.operators.numbering import number_within, page_within
from shelfmark.operators.transfer import pulled_names, transfer_ordinals
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, a null group, and many small ones."""
    data = [("hot", f"f{i:05d}") for i in range(3000)] + [(None, f"n{i}") for i in range(50)]
    data += [(f"d{i % 700}", f"g{i:05d}") for i in range(6000)]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, "parent string, path string").repartition(6)


def brute(df):
    groups = {}
    for parent, path in rows(df, "parent", "path"):
        groups.setdefault(parent, []).append(path)
    return sorted(((g, p, i) for g, paths in groups.items() for i, p in enumerate(sorted(paths))), key=repr)


@pytest.mark.parametrize("limit", [10**6, 100, 1])
def test_positions_do_not_depend_on_slicing(skewed, limit):
    got = number_within(skewed, ["parent"], ["path"], slice_rows=limit)
    assert rows(got, "parent", "path", "ordinal") == brute(skewed)


def test_several_keys(spark):
    data = [(a, b, f"{i:03d}") for a in (1, 2) for b in ("x", "y") for i in range(40)]
    df = spark.createDataFrame(data, "a int, b string, o string")
    whole = number_within(df, ["a", "b"], ["o"])
    sliced = number_within(df, ["a", "b"], ["o"], slice_rows=5)
    assert rows(whole) == rows(sliced)


def test_no_job_runs_while_the_plan_is_built(spark, skewed):
    spark.sparkContext.setJobGroup("planning", "planning")
    page_within(skewed, ["parent"], ["path"], 64, slice_rows=10)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert not jobs


def test_a_hot_group_is_numbered_in_slices(spark):
    df = spark.range(20_000).selectExpr("'hot' parent", "concat('f', lpad(reverse(id), 6, '0'), id) path")
    sizes = number_within(df, ["parent"], ["path"], slice_rows=1000)
    assert [r.ordinal for r in sizes.orderBy("path").collect()] == list(range(20_000))


def test_empty_input(spark):
    df = spark.createDataFrame([], "parent string, path string")
    assert number_within(df, ["parent"], ["path"]).count() == 0


def test_pages_are_whole_and_bounded(skewed):
    paged = page_within(skewed, ["parent"], ["path"], 64, slice_rows=200)
    sizes = paged.groupBy("parent", "page").count()
    assert paged.count() == skewed.count()
    assert max(r["count"] for r in sizes.collect()) == 64
    assert sizes.filter("parent = 'hot'").count() == -(-3000 // 64)
    with pytest.raises(ValueError):
        page_within(skewed, ["parent"], ["path"], 0)


def test_hot_directory_is_listed_whole(skewed):
    files = skewed.selectExpr("parent", "path as label", "'file' as type")
    pages = nested_listing(files, page_size=500, slice_rows=100).filter("parent = 'hot'").orderBy("page").collect()
    assert [name for p in pages for name in p.files] == [f"f{i:05d}" for i in range(3000)]
    lines = pulled_names(files, page_size=500, slice_rows=100).filter("parent = 'hot'").orderBy("page").collect()
    assert ", ".join(r.names for r in lines) == ", ".join(f"f{i:05d}" for i in range(3000))


def test_transfer_ordinals_start_at_zero(objects):
    got = rows(transfer_ordinals(objects.filter("type = 'file'")), "label", "ordinal")
    assert got == [("IMG_1.png", 0), ("f1.txt", 0), ("f1.txt", 1), ("f2.txt", 2)]
