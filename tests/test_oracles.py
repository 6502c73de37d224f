"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from shelfmark.plans import QUERIES
from tools.check_oracles import ORACLE_DIR, rows_of, type_gaps

SF = "/root/testdata/sf0.001"
ORACLES = {name: q.sql for name, q in QUERIES.items()}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name].run(spark, SF)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name].replace(ORACLE_DIR, SF))
    described = {d[0]: str(d[1]).lower() for d in cursor.description}
    assert mine == rows_of(list(described), cursor.fetchall())
    assert type_gaps(df, described) == {}


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert all(ORACLES.values())
