import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.operators import grants, tags
from shelfmark.sources import responses
from tests.conftest import HOME, plan_of, rows

SPECS = "id string, ns string, spec string"


@pytest.mark.parametrize("spec, attr, value", [
    ("k1=v1", "k1", "v1"), (" k=v \n", "k", "v"), ("\tk = v", "k ", " v"), ("a=b=c", "a", "b"),
    ("k=", "k", ""), ("=v", "", "v"), ("plain", "plain", None), ("", "", None), ("\x1f k=v ", "k", "v"),
])
def test_parse_follows_strip_and_split(frame, spec, attr, value):
    got = tags.parse_tags(frame(SPECS, ("1", "avus", spec))).first()
    assert (got.attr, got["value"], got.unit, got.rejected) == (attr, value, "", value is None)
    split = spec.strip().split("=")
    assert got.attr == split[0] and got["value"] == (split[1] if len(split) > 1 else None)


@pytest.fixture
def posted(frame):
    return tags.valid_tags(frame(SPECS, ("7", "avus", "k1=v1"), ("7", "avus", "k2=v2"), ("7", "irods-avus", "k3=v3")))


def test_round_trip_of_both_namespaces(posted, frame):
    ids = frame("id string", ("7",), ("7",), ("8",))
    assert rows(tags.get_tags(posted, ids), "attr", "value") == [("k1", "v1"), ("k2", "v2")]
    assert rows(tags.get_tags(posted, ids, irods=True), "attr", "value") == [("k3", "v3")]
    assert rows(tags.has_tag(posted, "k1", "v1")) == [("7", 2, 1)]
    assert rows(tags.has_tag(posted, "k1", "v2")) == []


def test_overwrite_replaces_both_namespaces(posted, frame):
    new = tags.valid_tags(frame(SPECS, ("7", "avus", "n=1"), ("9", "avus", "m=2")))
    got = tags.overwrite_tags(posted, new)
    assert rows(got, "id", "ns", "attr") == [("7", "avus", "n"), ("9", "avus", "m")]
    cleared = tags.overwrite_tags(posted, new.filter("id = '9'"), frame("id string", ("7",), ("9",)))
    assert rows(cleared, "id") == [("9",)]


def test_rendered_lines_and_payload(posted):
    assert rows(tags.render_tags(posted)) == [("7", "avus", 0, "k1=v1\nk2=v2"), ("7", "irods-avus", 0, "k3=v3")]
    body = json.loads(tags.tag_payloads(posted).first().payload)
    assert body == {
        "avus": [{"attr": "k1", "value": "v1", "unit": ""}, {"attr": "k2", "value": "v2", "unit": ""}],
        "irods-avus": [{"attr": "k3", "value": "v3", "unit": ""}],
    }
    only = tags.tag_payloads(posted.filter("ns = 'avus'")).first().payload
    assert json.loads(only)["irods-avus"] == []


def test_an_object_with_very_many_tags_is_posted_whole(spark):
    many = spark.range(1500).selectExpr("'hot' id", "'avus' ns", "concat('k', id) attr", "'v' value", "'' unit")
    posted = tags.tag_payloads(many).select(F.col("id").alias("rid"), F.col("payload").alias("body"))
    assert posted.count() == 1
    read = responses.tag_rows(posted).withColumnRenamed("rid", "id")
    after = tags.overwrite_tags(many.limit(3), read)
    assert rows(after, "attr") == rows(many, "attr")
    lines = [line for r in tags.render_tags(many, 300, 500).collect() for line in r.tags.split("\n")]
    assert sorted(lines) == sorted(f"k{i}=v" for i in range(1500))


def test_a_malformed_tag_rejects_the_whole_post(frame):
    current = frame("id string, ns string, attr string, value string, unit string", ("1", "avus", "old", "v", ""), ("2", "avus", "old", "v", ""))
    specs = frame("id string, ns string, spec string", ("1", "avus", "a=b"), ("1", "avus", "bad"), ("2", "avus", "c=d"))
    assert rows(tags.post_tags(current, specs), "id", "attr") == [("1", "old"), ("2", "c")]
    assert rows(tags.rejected_posts(specs)) == [("1", 1)]
    with pytest.raises(PySparkException, match="malformed tag of 1"):
        tags.post_tags(current, specs, strict=True).collect()


GRANT = "usr string, path string, permission string"
CHANGE = "seq int, usr string, path string, permission string"


@pytest.fixture
def current(frame):
    return frame(GRANT, ("ann", HOME + "/a", "read"), ("ann", HOME + "/b", "write"), ("bob", HOME + "/a", "read"))


def test_share_sets_the_last_valid_permission(current, frame):
    changes = frame(
        CHANGE, (1, "ann", HOME + "/a", "read"), (3, "ann", HOME + "/a", "write"), (2, "cat", HOME + "/c", "read"),
        (4, "ann", HOME + "/a", "own"), (5, "ann", "/tmp/a", "read"), (6, "dan", None, "read"), (7, "eve", HOME + "/e", None),
    )
    got = grants.share(current, changes, HOME)
    assert plan_of(got).count("Exchange") == 1
    assert rows(got) == [
        ("ann", HOME + "/a", "write"), ("ann", HOME + "/b", "write"), ("bob", HOME + "/a", "read"), ("cat", HOME + "/c", "read"),
    ]


def test_one_bad_pair_rejects_the_request(current, frame):
    pair = "array<struct<path string, permission string>>".replace("path ", "path:").replace("permission ", "permission:")
    requests = frame(
        f"rid int, usr string, paths {pair}",
        (1, "cat", [(HOME + "/x", "read"), (HOME + "/y", "write")]),
        (2, "dan", [(HOME + "/x", "read"), (HOME + "/y", "own")]),
        (3, "eve", [(HOME + "/x", "read"), ("/tmp/y", "read")]),
        (4, "cat", [(HOME + "/x", "write"), (HOME + "/x", "read")]),
        (5, "fay", [(None, "read")]),
        (6, "gus", None),
    )
    checked = dict(rows(grants.check_share_requests(requests, HOME), "rid", "ok"))
    assert checked == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}
    got = [r for r in rows(grants.share_many(current, requests, HOME)) if r[0] not in ("ann", "bob")]
    assert got == [("cat", HOME + "/x", "read"), ("cat", HOME + "/y", "write")]


def test_unshare_ignores_the_permission(current, frame):
    gone = frame("usr string, path string", ("ann", HOME + "/b"), ("ann", HOME + "/b"), ("bob", HOME + "/zzz"))
    assert rows(grants.unshare(current, gone, HOME), "usr", "path") == [("ann", HOME + "/a"), ("bob", HOME + "/a")]


def test_unshare_many_and_users(current, frame):
    many = frame(
        "usr string, paths array<string>", ("ann", [HOME + "/a", HOME + "/b"]), ("bob", [HOME + "/a", "/tmp/x"]),
    )
    assert rows(grants.unshare_many(current, many, HOME), "usr") == [("bob",)]
    users = frame("path string, users array<string>", (HOME + "/a", ["ann", "bob", "cat"]))
    assert rows(grants.unshare_users(current, users, HOME), "usr", "path") == [("ann", HOME + "/b")]


def test_log_folds_to_the_last_action(spark):
    random.seed(5)
    log = [
        (seq, random.randrange(20), f"u{random.randrange(4)}", f"/p{random.randrange(5)}",
         random.choice(["share", "share", "unshare"]), random.choice(["read", "write"]))
        for seq in range(400)
    ]
    want = {}
    for seq, ts, usr, path, action, permission in sorted(log, key=lambda r: (r[1], r[0])):
        want[usr, path] = permission if action == "share" else None
    df = spark.createDataFrame(log, "seq int, ts int, usr string, path string, action string, permission string")
    expected = sorted((u, p, perm) for (u, p), perm in want.items() if perm)
    assert rows(grants.current_grants(df)) == expected


def test_share_payloads_are_paged_whole(spark):
    many = spark.range(2500).selectExpr("'hot' usr", "concat('/store/home/', id) path", "'read' permission")
    bodies = [json.loads(r.payload) for r in grants.share_payloads(many, 200, 300).collect()]
    entries = [body["sharing"][0] for body in bodies]
    assert {e["user"] for e in entries} == {"hot"} and max(len(e["paths"]) for e in entries) == 200
    assert sorted(p["path"] for e in entries for p in e["paths"]) == sorted(f"/store/home/{i}" for i in range(2500))
