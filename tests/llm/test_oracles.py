"""The queries that have SQL, against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from shelfmark.llm import ORACLE_SQL, QUERIES
from tests.llm.helpers import SF
from tools.check_oracles import rows_of, type_gaps


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    df = QUERIES[name](spark, SF)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLE_SQL[name])
    described = {d[0]: str(d[1]).lower() for d in cursor.description}
    assert mine == rows_of(list(described), cursor.fetchall())
    assert type_gaps(df, described) == {}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
