import json

import pytest

from shelfmark.operators import grants, reports
from shelfmark.sources import responses
from tests.conftest import HOME, rows

BAD = [("bad", "not json"), ("null", None), ("other", '{"other":1}')]


@pytest.fixture
def logged(frame):
    def make(*bodies):
        good = [(str(i), json.dumps(b)) for i, b in enumerate(bodies)]
        return frame("rid string, body string", *good, *BAD)

    return make


def test_listing(logged):
    file = {"path": "/h/f1.txt", "label": "f1.txt", "md5": "aa", "id": "7", "extra": 1}
    log = logged({"files": [file], "folders": [{"path": "/h/d", "label": "d"}]}, {"files": []}, {"folders": None})
    got = rows(responses.listing_rows(log), "rid", "type", "path", "label", "md5", "id")
    assert got == [("0", "dir", "/h/d", "d", None, None), ("0", "file", "/h/f1.txt", "f1.txt", "aa", "7")]
    complete = dict(rows(reports.require_keys(log, ["files", "folders"]), "rid", "complete"))
    assert complete == {"0": True, "1": False, "2": False, "bad": False, "null": False, "other": False}


def test_stat(logged):
    log = logged({"paths": {"/h/f1.txt": {"id": "7", "type": "file"}, "/h/gone": None}}, {"paths": None}, {"paths": {}})
    got = rows(responses.stat_rows(log), "rid", "path", "label", "parent", "type", "id", "md5")
    assert got == [("0", "/h/f1.txt", "f1.txt", "/h", "file", "7", None)]


def test_existence_and_users(logged):
    assert rows(responses.existence_rows(logged({"paths": {"/a": True, "/b": False}})), "path", "exists") == [
        ("/a", True), ("/b", False),
    ]
    got = responses.user_rows(logged({"ann": {"id": "ann", "email": "a@x"}}).filter("rid = '0'"))
    assert rows(got) == [("0", "ann", {"id": "ann", "email": "a@x"})]


def test_tags(logged):
    tag = {"attr": "k", "value": "v", "unit": ""}
    log = logged({"avus": [tag, tag], "irods-avus": [tag]}, {"avus": []}, {"irods-avus": [tag]})
    got = rows(responses.tag_rows(log), "rid", "ns", "attr")
    assert got == [("0", "avus", "k")] * 2 + [("0", "irods-avus", "k"), ("2", "irods-avus", "k")]


def test_sharing_bodies_round_trip(frame):
    current = frame("usr string, path string, permission string", ("ann", HOME + '/q"t', "read"), ("bob", HOME + "/a", "write"))
    log = grants.share_payloads(current).selectExpr("usr as rid", "payload as body")
    assert rows(responses.share_rows(log), "usr", "path", "permission") == rows(current)
    log = grants.unshare_payloads(current.union(current)).selectExpr("usr as rid", "payload as body")
    assert rows(responses.unshare_rows(log), "usr", "path") == rows(current, "usr", "path")
