import pytest

from shelfmark.operators import ranks
from shelfmark.operators.ranks import pages_within, ranked_within
from tests.conftest import rows
from tests.test_numbering import brute, skewed  # noqa: F401


@pytest.mark.parametrize("range_rows", [10**6, 500, 20])
def test_positions_do_not_depend_on_the_ranges(skewed, range_rows):  # noqa: F811
    got = ranked_within(skewed, ["parent"], ["path"], total="n", range_rows=range_rows)
    assert rows(got, "parent", "path", "ordinal") == brute(skewed)
    assert rows(got.select("parent", "n").distinct()) == rows(skewed.groupBy("parent").count())


def test_equal_rows_are_cut_into_ranges(spark):
    df = spark.range(20_000).selectExpr("'hot' k", "1 o", "'same' v").repartition(4)
    got = ranked_within(df, ["k"], ["o"], range_rows=1000)
    assert sorted(r.ordinal for r in got.collect()) == list(range(20_000))


def test_the_input_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(5000).selectExpr("id % 3 k", "id").mapInArrow(count, "k long, id long")
    assert ranked_within(df, ["k"], ["id"], range_rows=100).count() == 5000
    assert seen.value == 5000


def test_ranges_of_a_few_rows(spark, monkeypatch):
    monkeypatch.setattr(ranks, "_SMALLEST_RANGE", 1)
    df = spark.createDataFrame([(k % 3, k % 5, k) for k in range(120)], "a int, o int, v int")
    got = ranked_within(df, ["a"], ["o", "v"], total="n", range_rows=3)
    for a in range(3):
        own = sorted((v % 5, v) for v in range(120) if v % 3 == a)
        assert rows(got.filter(f"a = {a}"), "ordinal", "v", "n") == sorted(((at, v, 40) for at, (_, v) in enumerate(own)), key=repr)


def test_no_keys_several_keys_and_an_empty_table(spark):
    data = [(a, b, f"{i:03d}") for a in (1, None) for b in ("x", "y") for i in range(40)]
    df = spark.createDataFrame(data, "a int, b string, o string")
    got = ranked_within(df, ["a", "b"], ["o"], range_rows=7)
    assert all(r.ordinal == int(r.o) for r in got.collect())
    assert sorted(r.ordinal for r in ranked_within(df, [], ["a", "b", "o"], range_rows=7).collect()) == list(range(160))
    assert ranked_within(df.limit(0), ["a"], ["o"]).count() == 0


def test_pages(skewed):  # noqa: F811
    paged = pages_within(skewed, ["parent"], ["path"], 64, range_rows=200)
    assert max(r["count"] for r in paged.groupBy("parent", "page").count().collect()) == 64
    with pytest.raises(ValueError):
        pages_within(skewed, ["parent"], ["path"], 0)
