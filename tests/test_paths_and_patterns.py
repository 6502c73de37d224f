import posixpath

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions.paths import join_path, label_of, normalize_path, parent_of, under_home
from shelfmark.functions.patterns import FileRules, matches_any
from shelfmark.operators.selection import difference, match_pattern_table, select_files, union_distinct
from tests.conftest import plan_of, rows

MIXED = "/some/PATH/with/LOWER/and/UPPER/cAsE"


@pytest.mark.parametrize(
    "pattern, expected",
    [("some", True), ("case", True), ("lower", True), ("LOWER", True), ("upper", True), ("nomatch", False)],
)
def test_a_pattern_is_a_case_insensitive_substring(frame, pattern, expected):
    df = frame("path string", (MIXED,))
    assert df.select(matches_any(F.col("path"), [pattern])).first()[0] is expected


@pytest.mark.parametrize("pattern, path, expected", [
    ("%", "/a/b", False), ("_", "/ab", False), ("a.b", "/axb", False), ("*", "/a/b", False), ("%", "/50%", True),
])
def test_wildcards_are_plain_characters(frame, pattern, path, expected):
    df = frame("path string", (path,))
    assert df.select(matches_any(F.col("path"), [pattern])).first()[0] is expected


def test_no_patterns_match_nothing(frame):
    df = frame("path string", (MIXED,))
    assert df.select(matches_any(F.col("path"), []), matches_any(F.col("path"), None)).first() == (False, False)


def test_path_parts(frame):
    paths = ["/a/b/c.txt", "/a", "/", "/a/b/", "a", "", "//", "/a//b"]
    df = frame("path string", *[(p,) for p in paths])
    got = df.select("path", label_of(F.col("path")), normalize_path(F.col("path")), parent_of(F.col("path")))
    by_path = {r[0]: tuple(r)[1:] for r in got.collect()}
    for path in paths:
        assert by_path[path][0] == path.rpartition("/")[2]
    assert by_path["/a/b/"][1] == "/a/b"
    assert by_path["/"][1] == "/" and by_path["//"][1] == "/" and by_path[""][1] == ""
    assert by_path["/a/b/c.txt"][2] == "/a/b" and by_path["/a"][2] == "/" and by_path["a"][2] == ""


@pytest.mark.parametrize("prefix, name", [("/a", "b"), ("/a/", "b"), ("/a", "/b"), ("", "b"), ("/", "b")])
def test_join_path_follows_posix(frame, prefix, name):
    df = frame("p string, n string", (prefix, name))
    assert df.select(join_path(F.col("p"), F.col("n"))).first()[0] == posixpath.join(prefix, name)


def test_home_prefix(frame):
    df = frame("path string", ("/store/home/a",), ("/store/homes/a",), ("/tmp/x",), (None,), ("/store/home",))
    got = df.select(under_home(F.col("path"), "/store/home")).collect()
    assert [r[0] for r in got] == [True, False, False, False, False]


def brute_select(files, rules):
    """The rule as the documentation states it."""
    kept = []
    for path, label in files:
        included = not rules.include_patterns and not rules.include_names
        included |= any(p.lower() in path.lower() for p in rules.include_patterns or ())
        included |= label in (rules.include_names or ()) or path in (rules.include_names or ())
        excluded = any(p.lower() in path.lower() for p in rules.exclude_patterns or ())
        excluded |= label in (rules.exclude_names or ())
        if included and not excluded:
            kept.append((path,))
    return sorted(kept)


NAMES = ["a.txt", "A.TXT", "b.csv", "ab.txt", "c"]
FILES = [(f"/{d}/{n}", n) for d in ("x", "Y") for n in NAMES]
LISTS = st.one_of(st.none(), st.lists(st.sampled_from(["a", "TXT", "/x/", "y", "zz", "."]), max_size=2))
NAME_LISTS = st.one_of(st.none(), st.lists(st.sampled_from([*NAMES, "/x/a.txt", "/Y/c"]), max_size=2))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LISTS, NAME_LISTS, LISTS, NAME_LISTS)
def test_select_files_equals_the_written_rule(spark, ip, inn, ep, en):
    rules = FileRules(ip, inn, ep, en)
    df = spark.createDataFrame(FILES, "path string, label string")
    assert rows(select_files(df, rules), "path") == brute_select(FILES, rules)


def test_empty_lists_mean_no_rule(spark):
    df = spark.createDataFrame(FILES, "path string, label string")
    assert select_files(df, FileRules([], [], [], [])).count() == len(FILES)


def test_exclude_names_ignore_full_paths(spark):
    df = spark.createDataFrame(FILES, "path string, label string")
    assert select_files(df, FileRules(exclude_names=["/x/a.txt"])).count() == len(FILES)
    assert rows(select_files(df, FileRules(include_names=["/x/a.txt"])), "path") == [("/x/a.txt",)]


PATHS = [f"/store/home/{u}/{d}/file_{i}.txt" for u in ("Ann", "bob") for d in ("raw", "x") for i in range(12)] + ["", "é/Ñ"]
PATTERNS = ["ANN", "store/home/bob/x/file_7", "/store/home/ann/zzz", "STORE", "file_1.", "/x/", "nothing here", "é", "_11.t", "o", "bo", "RAW/file_3", "zzzz"]


@pytest.mark.parametrize("patterns", [PATTERNS, ["zz", "zzzz"], ["o"], ["", "zz"], [], [None, "ann"], ["b/r"], ["É/ñ"], ["home/bob/raw/file_11.txt", "b"]])
def test_pattern_table_equals_brute_force(frame, patterns):
    paths = frame("path string", *[(p,) for p in [*PATHS, *PATHS[:3], None]])
    table = frame("pattern string", *[(p,) for p in patterns])
    want = sorted(
        (p,) for p in PATHS + PATHS[:3] if any(q is not None and q.lower() in p.lower() for q in patterns)
    )
    got = sorted(rows(match_pattern_table(paths, table)))
    assert got == want


def test_pattern_tables_are_matched_by_equi_joins(frame):
    paths = frame("path string", *[(p,) for p in PATHS])
    table = frame("pattern string", *[(p,) for p in PATTERNS])
    plan = plan_of(match_pattern_table(paths, table))
    assert "Join" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_set_operations(frame):
    a = frame("path string", ("x",), ("y",), ("x",))
    b = frame("path string", ("y",), ("z",))
    assert rows(union_distinct(a, b)) == [("x",), ("y",), ("z",)]
    assert rows(difference(a, b)) == [("x",), ("x",)]
