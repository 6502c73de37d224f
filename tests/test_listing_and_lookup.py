import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.operators import listing, lookup
from tests.conftest import plan_of, rows

DATA = "/store/home/me/data"


def test_list_directory_is_direct_children_only(objects):
    got = rows(listing.list_directory(objects, "/store/home/me/"), "label", "type", "status")
    assert got == [("data", "dir", "ok"), ("empty", "dir", "ok"), ("f1.txt", "file", "ok")]


def test_list_directory_of_a_missing_path_or_a_file_is_invalid(objects):
    for path in ("/store/home/nope", DATA + "/f1.txt"):
        assert rows(listing.list_directory(objects, path), "path", "label", "status") == [(path, None, "invalid_path")]


def test_list_directory_of_an_empty_directory_is_empty(objects):
    assert listing.list_directory(objects, "/store/home/me/empty").count() == 0


def test_list_directory_takes_the_first_entries_by_label(objects):
    got = listing.list_directory(objects, DATA, limit=2)
    assert rows(got, "label") == [("IMG_1.png",), ("f1.txt",)]
    assert "TakeOrderedAndProject" in plan_of(got)
    assert listing.list_directory(objects, DATA, limit=None).count() == 3


def test_list_directory_has_no_limit_unless_asked(spark):
    df = spark.range(1500).selectExpr("concat('/h/f', id) path", "concat('f', id) label", "'/h' parent", "'file' type")
    found = listing.list_directory(df, "/h").collect()
    assert len(found) == 1500 and {r.status for r in found} == {"ok"}  # known from its children alone
    assert [r.status for r in listing.list_directory(df, "/h/f1").collect()] == ["invalid_path"]
    with pytest.raises(PySparkException, match="no such directory"):
        listing.list_directory(df, "/none", strict=True).collect()


def test_files_and_folders(objects):
    assert rows(listing.list_files(objects, DATA), "label") == [("IMG_1.png",), ("f1.txt",), ("f2.txt",)]
    assert rows(listing.list_folders(objects, "/store/home/me"), "label") == [("data",), ("empty",)]
    assert listing.list_files(objects, DATA, limit=1).count() == 1
    with pytest.raises(ValueError):
        listing.of_type(objects, "link")


def test_list_many_keeps_every_request(objects, frame):
    asked = frame("ord int, path string", (0, DATA + "/"), (1, "/nope"), (2, "/store/home/me/empty"), (3, DATA))
    got = rows(listing.list_many(asked, objects), "ord", "label", "status")
    assert [r for r in got if r[0] == 0] == [(0, "IMG_1.png", "ok"), (0, "f1.txt", "ok"), (0, "f2.txt", "ok")]
    assert [r for r in got if r[0] == 1] == [(1, None, "invalid_path")]
    assert [r for r in got if r[0] == 2] == [(2, None, "empty")]
    assert len([r for r in got if r[0] == 3]) == 3


def test_nested_listing_pages(objects):
    whole = {r.parent: r for r in listing.nested_listing(objects).collect()}
    assert whole["/store/home/me"].files == ["f1.txt"] and whole["/store/home/me"].folders == ["data", "empty"]
    paged = listing.nested_listing(objects, page_size=2).filter(F.col("parent") == DATA).orderBy("page").collect()
    assert [(r.page, r.files) for r in paged] == [(0, ["IMG_1.png", "f1.txt"]), (1, ["f2.txt"])]


def test_make_directories_is_idempotent(objects, frame):
    asked = frame("path string", ("/store/home/new/",), ("/store/home/new",), (DATA,), ("/store/home/me/f1.txt",))
    once = listing.make_directories(objects, asked)
    assert once.count() == objects.count() + 1
    made = once.filter("path = '/store/home/new'").first()
    assert (made.label, made.parent, made.type, made.size) == ("new", "/store/home", "dir", None)
    assert listing.make_directories(once, asked).count() == once.count()
    assert once.filter("path = '/store/home/me/f1.txt'").first().type == "file"


@pytest.fixture
def asked(frame):
    return frame(
        "rid int, path string, want string",
        (1, DATA, None), (2, DATA + "/", "dir"), (3, DATA + "/f1.txt", "file"), (4, DATA + "/f9.txt", None),
        (5, DATA + "/f1.txt", "dir"), (6, DATA, "file"), (7, DATA, "link"), (8, None, None),
    )


def test_existence_with_and_without_trailing_slash(objects, asked):
    got = dict(rows(lookup.paths_exist(asked, objects), "rid", "exists"))
    assert got == {1: True, 2: True, 3: True, 4: False, 5: True, 6: True, 7: True, 8: False}


def test_existence_of_a_type(objects, asked):
    dirs = dict(rows(lookup.type_exists(asked, objects, "dir"), "rid", "exists"))
    files = dict(rows(lookup.type_exists(asked, objects, "file"), "rid", "exists"))
    assert [dirs[i] for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert [files[i] for i in (1, 2, 3, 4)] == [False, False, True, False]
    with pytest.raises(ValueError):
        lookup.type_exists(asked, objects, "link")


def test_exists_by_type(objects, asked):
    got = dict(rows(lookup.exists_by_type(asked, objects), "rid", "result"))
    assert got == {1: "yes", 2: "yes", 3: "yes", 4: "no", 5: "no", 6: "no", 7: "bad_type", 8: "no"}


def test_stat(objects, asked):
    got = {r.rid: r for r in lookup.stat_paths(asked, objects).collect()}
    assert got[3].found and got[3].id == "1" and got[3].md5 == "aa"
    assert not got[4].found and got[4].type is None
    with pytest.raises(PySparkException, match="f9.txt|null"):
        lookup.stat_paths(asked, objects, strict=True).collect()


def test_lookup_users(frame):
    users = frame("username string, email string", ("ann", "a@x"))
    got = lookup.lookup_users(frame("username string", ("ann",), ("bob",), (None,)), users)
    assert rows(got) == [("ann", "a@x", True), ("bob", None, False), (None, None, False)]


def test_resolve_requests(objects, frame):
    asked = frame("rid int, path string", (1, DATA), (2, DATA + "/f1.txt/"), (3, "/nope"), (4, "/store/home/me/empty"))
    got = rows(lookup.resolve_requests(asked, objects), "rid", "file", "status")
    assert [r[1] for r in got if r[0] == 1] == [DATA + "/IMG_1.png", DATA + "/f1.txt", DATA + "/f2.txt"]
    assert [r for r in got if r[0] > 1] == [(2, DATA + "/f1.txt", "ok"), (3, None, "missing")]
