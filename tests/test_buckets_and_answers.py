"""Bucketed tables, answers without repetition, the lookup catalog, formats and strict sharing."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.sizes import SYMBOLS, readable_bytes
from shelfmark.operators import grants, listing, lookup, selection, tags
from shelfmark.sources.buckets import BucketedTable, bucket_of
from shelfmark.sources.catalog import write_lookup_catalog
from tests.conftest import plan_of, rows

TAGS = "id string, ns string, attr string, value string, unit string"


@pytest.fixture
def table(spark, tmp_path):
    made = BucketedTable(spark, str(tmp_path / "tags"), ["id"], TAGS, buckets=8)
    made.write(spark.createDataFrame([(f"i{k}", "avus", "a", str(k), "") for k in range(200)], TAGS))
    return made


def stamps(table):
    found = {}
    for folder, _, names in os.walk(table.location):
        found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return found


def test_one_posted_id_rewrites_one_bucket(spark, table):
    before, whole = stamps(table), rows(table.read())
    incoming = spark.createDataFrame([("i7", "avus", "new", "x", "")], TAGS)
    touched = table.change(incoming.select("id"), lambda current: tags.overwrite_tags(current, incoming))
    assert len(touched) == 1
    after = stamps(table)
    changed = {os.path.dirname(p).rpartition("=")[2] for p in before.keys() ^ after.keys()}
    assert changed == {str(touched[0])}
    assert all(before[p] == after[p] for p in before.keys() & after.keys())
    wanted = [r for r in whole if r[0] != "i7"] + [("i7", "avus", "new", "x", "")]
    assert rows(table.read()) == sorted(wanted, key=repr)


def test_a_bucket_that_empties_is_gone(spark, table):
    number = table.read().filter("id = 'i7'").select(bucket_of(["id"], 8)).first()[0]
    mine = table.read().filter(bucket_of(["id"], 8) == number).select("id")
    table.change(mine, lambda current: current.filter(F.lit(False)))
    assert not os.path.exists(f"{table.location}/_bucket={number}")
    assert table.read().filter(bucket_of(["id"], 8) == number).isEmpty()
    # And comes back.
    again = spark.createDataFrame([("i7", "avus", "back", "", "")], TAGS)
    table.change(again.select("id"), lambda current: tags.overwrite_tags(current, again))
    assert rows(table.read().filter("id = 'i7'"), "attr") == [("back",)]


def test_keys_that_were_not_named_are_refused(spark, table):
    other = table.read()
    with pytest.raises(ValueError, match="not named"):
        table.change(spark.createDataFrame([("i7",)], "id string"), lambda current: other)
    assert table.change(spark.createDataFrame([], "id string"), lambda current: current) == []
    assert table.read().count() == 200


def test_reading_for_keys_opens_their_buckets(spark, table):
    few = table.read_for(spark.createDataFrame([("i7",)], "id string"))
    assert "PartitionFilters: [isnotnull(_bucket" in plan_of(few) or "PartitionFilters" in plan_of(few)
    assert few.select(F.input_file_name()).distinct().count() <= 4
    assert few.filter("id = 'i7'").count() == 1


def test_answers_without_repetition(spark):
    objects = [("/h/d", "d", "/h", "dir"), ("/h/e", "e", "/h", "dir"), ("/h", "h", "/", "dir")]
    objects += [(f"/h/d/f{k}", f"f{k}", "/h/d", "file") for k in range(2000)]
    catalog = spark.createDataFrame(objects, "path string, label string, parent string, type string")
    asked = [(k, "/h/d/") for k in range(1000)] + [(1000, "/h/nope"), (1001, "/h/e"), (1002, "/h/d/f3"), (1003, None)]
    requests = spark.createDataFrame(asked, "rid long, path string")
    answer = lookup.resolve_targets(requests, catalog)
    assert (answer.targets.count(), answer.files.count()) == (1004, 2000 + 1)
    few = spark.createDataFrame(asked[998:], "rid long, path string")
    wanted = rows(lookup.resolve_requests(few, catalog), "rid", "target", "file", "status")
    assert rows(lookup.resolve_targets(few, catalog).expanded(), "rid", "target", "file", "status") == wanted

    answers, entries = listing.list_targets(few.withColumnRenamed("rid", "ord"), catalog)
    found = {r.ord: (r.n_entries, r.status) for r in answers.collect()}
    assert found == {998: (2000, "ok"), 999: (2000, "ok"), 1000: (0, "invalid_path"), 1001: (0, "empty"), 1002: (0, "invalid_path"), 1003: (0, "invalid_path")}
    assert entries.count() == 2000


def test_a_lookup_catalog_is_not_moved(spark, objects, tmp_path):
    stored = write_lookup_catalog(objects, "lookup_catalog_test", str(tmp_path / "catalog"), buckets=4)
    requests = spark.createDataFrame([(1, "/store/home/me/data/"), (2, "/nope"), (3, "/store/home/me/f1.txt")], "rid int, path string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup.stat_paths(requests, stored)
        assert rows(found) == rows(lookup.stat_paths(requests, objects))
        # Only the requests are exchanged.
        plan = plan_of(found).split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table lookup_catalog_test")


def test_patterns_through_the_sketch_equal_brute_force(spark):
    draw = random.Random(5)
    paths = [None, "", "/A"] + ["/store/" + "".join(draw.choices("abXY/_", k=draw.randint(0, 14))) for _ in range(3000)]
    patterns = [None, "Zz", "ab", "XY/", "/A", "b"] + ["".join(draw.choices("abxy/_", k=draw.randint(3, 9))) for _ in range(200)]
    for chosen in (patterns[:3], patterns[2:5], patterns[6:], ["", "qq"], []):
        got = selection.match_pattern_table(
            spark.createDataFrame([(p,) for p in paths], "path string"), spark.createDataFrame([(p,) for p in chosen], "pattern string")
        )
        wanted = [(p,) for p in paths if p is not None and any(c is not None and c.lower() in p.lower() for c in chosen)]
        assert rows(got) == sorted(wanted, key=repr)


COUNTS = [0, 1, 999, 1023, 1024, 1536, 9856, 10_000, 1 << 20, 5_000_000, (1 << 40) - 1, 1 << 40, (1 << 53) + 1, (1 << 60) + 12345, (1 << 63) - 1]


def plain(n, format, family):
    """What printf-style formatting of the value in its largest unit gives."""
    names = SYMBOLS[family]
    step = max([k for k in range(1, len(names)) if n >= 1 << (10 * k)], default=0)
    return format % {"symbol": names[step], "value": float(n) / (1 << (10 * step)) if step else n}


FORMATS = [
    "%(value)d %(symbol)s", "%(value)i", "%(value)f", "%(value)8.2f|%(symbol)5s|", "%(value)-8.1f|", "%(value)08.3f",
    "%(value)+.1f%%", "%(value)+09.1f", "%(value) .0f", "%(value)d of %(value).4f %(symbol)-6s!", "%(value)d%(symbol).1s",
]


@pytest.mark.parametrize("family", ["customary", "iec_ext"])
def test_formats_equal_printf(spark, family):
    df = spark.createDataFrame([(n,) for n in [*COUNTS, -1]], "n long")
    for kind in ("long", "decimal(38,0)"):
        texts = [readable_bytes(F.col("n").cast(kind), f, family).alias(f"t{k}") for k, f in enumerate(FORMATS)]
        got = [tuple(r) for r in df.select(*texts).collect()]
        assert got == [tuple(plain(n, f, family) for f in FORMATS) for n in COUNTS] + [(None,) * len(FORMATS)]


def test_formats_that_cannot_be_read():
    for format in ("%(value)x", "%d", "%(size)s", "50% %(value).1f", "%(symbol)s"):
        with pytest.raises(ValueError):
            readable_bytes(F.lit(1), format)


def test_strict_sharing_fails_on_a_bad_permission(spark):
    none = spark.createDataFrame([], "usr long, path string, permission string")
    good, bad = (1, 1, "/store/home/a", "read"), (2, 1, "/store/home/a", "own")
    schema = "seq long, usr long, path string, permission string"
    changes = spark.createDataFrame([good, bad], schema)
    assert rows(grants.share(none, changes, "/store/home")) == [(1, "/store/home/a", "read")]
    assert rows(grants.share(none, changes.filter("seq = 1"), "/store/home", strict=True)) == [(1, "/store/home/a", "read")]
    with pytest.raises(Exception, match="neither read nor write"):
        grants.share(none, changes, "/store/home", strict=True).collect()
    many = changes.groupBy("usr").agg(F.collect_list(F.struct("path", "permission")).alias("paths")).withColumn("rid", F.lit(1))
    assert rows(grants.share_many(none, many, "/store/home")) == []
    with pytest.raises(Exception, match="neither read nor write"):
        grants.share_many(none, many, "/store/home", strict=True).collect()
