from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfmark.session import local_session  # noqa: E402

HOME = "/store/home"

# A small catalog: two directories with files, one empty, one nested.
CATALOG = [
    ("/store/home/me", "me", "/store/home", "dir", "d0", None, None),
    ("/store/home/me/data", "data", "/store/home/me", "dir", "d1", None, None),
    ("/store/home/me/empty", "empty", "/store/home/me", "dir", "d2", None, None),
    ("/store/home/me/data/f1.txt", "f1.txt", "/store/home/me/data", "file", "1", "aa", 9),
    ("/store/home/me/data/f2.txt", "f2.txt", "/store/home/me/data", "file", "2", "bb", 1024),
    ("/store/home/me/data/IMG_1.png", "IMG_1.png", "/store/home/me/data", "file", "3", "cc", 5000),
    ("/store/home/me/f1.txt", "f1.txt", "/store/home/me", "file", "4", "dd", 7),
]
CATALOG_SCHEMA = "path string, label string, parent string, type string, id string, md5 string, size bigint"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="shelfmark-tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def objects(spark):
    return spark.createDataFrame(CATALOG, CATALOG_SCHEMA)


@pytest.fixture
def frame(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
