import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.operators.integrity import checksum_summary, verify_checksums
from shelfmark.operators.transfer import first_wins, match_counts, plan_actions, skip_existing
from shelfmark.sources.store import plan_export
from tests.conftest import plan_of, rows


@pytest.fixture
def actual(frame):
    return frame("label string, md5 string", ("a", "1"), ("b", "2"), ("c", "3"), ("d", None), ("e", "5"), ("e", "5"))


@pytest.fixture
def manifest(frame):
    return frame("name string, checksum string", ("a", "1"), ("b", "x"), ("d", "4"), ("z", "9"), ("e", "5"))


def test_every_status(actual, manifest):
    got = rows(verify_checksums(actual, manifest), "name", "status")
    assert got == [
        ("a", "ok"), ("b", "mismatch"), ("c", "unexpected"), ("d", "mismatch"), ("e", "duplicate"), ("z", "missing"),
    ]
    summary = checksum_summary(verify_checksums(actual, manifest)).first()
    assert (summary.n_ok, summary.n_mismatch, summary.n_unexpected, summary.n_missing, summary.n_duplicate) == (1, 2, 1, 1, 1)
    assert not summary.passed


def test_matching_sets_pass(frame):
    files = frame("label string, md5 string", ("a", "1"), ("b", "2"))
    same = files.selectExpr("label as name", "md5 as checksum")
    assert checksum_summary(verify_checksums(files, same)).first().passed
    assert not checksum_summary(verify_checksums(files, same.limit(1))).first().passed


def test_the_same_name_in_two_directories(frame):
    files = frame("parent string, label string, md5 string", ("/a", "README", "1"), ("/b", "README", "2"))
    want = frame("parent string, name string, checksum string", ("/a", "README", "1"), ("/b", "README", "1"))
    got = verify_checksums(files, want, within=["parent"])
    assert rows(got, "parent", "status") == [("/a", "ok"), ("/b", "mismatch")]
    by_dir = rows(checksum_summary(got, within=["parent"]), "parent", "passed")
    assert by_dir == [("/a", True), ("/b", False)]


def test_verification_is_one_shuffle_with_map_side_combine(actual, manifest):
    plan = plan_of(verify_checksums(actual, manifest))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "partial_max" in plan


def test_actions(frame):
    sources = frame("label string", ("a",), ("b",))
    existing = frame("label string", ("a",), ("a",))
    assert rows(plan_actions(sources, existing)) == [("a", "skip"), ("b", "copy")]
    assert rows(plan_actions(sources, existing, overwrite=True)) == [("a", "overwrite"), ("b", "copy")]
    assert rows(skip_existing(sources, existing)) == [("b",)]


def test_first_source_of_a_name_wins(frame):
    sources = frame("path string, label string, size int", ("/b/x", "x", 2), ("/a/x", "x", 1), ("/a/y", "y", 3))
    assert rows(first_wins(sources)) == [("/a/x", "x", 1), ("/a/y", "y", 3)]


def test_match_counts(frame):
    asked = frame("rid int", (1,), (2,))
    selected = frame("rid int, path string", (1, "a"), (1, "b"))
    assert rows(match_counts(asked, selected)) == [(1, 2, False), (2, 0, True)]
    with pytest.raises(PySparkException, match="nothing selected for 2"):
        match_counts(asked, selected, strict=True).collect()


def test_export_plan(objects, frame):
    files = objects.filter("type = 'file'")
    there = frame("label string", ("f2.txt",))
    manifest = frame("name string, checksum string", ("f2.txt", "bb"), ("IMG_1.png", "zz"))
    plan = plan_export(files, there, manifest=manifest)
    got = rows(plan, "label", "path", "action", "status")
    assert got == [
        ("IMG_1.png", "/store/home/me/data/IMG_1.png", "copy", "mismatch"),
        ("f1.txt", "/store/home/me/data/f1.txt", "copy", "duplicate"),
        ("f2.txt", "/store/home/me/data/f2.txt", "skip", "ok"),
    ]
    assert plan_export(files, there, overwrite=True).filter(F.col("action") == "overwrite").count() == 1
