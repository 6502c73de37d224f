"""Copies of a file of fifty chunks by a process whose heap does not hold them three times."""

import ast
import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
RUN = """
import sys
from __spark_entry__ import queries
from shelfmark.session import local_session
spark = local_session(2, memory="512m")
print("ROWS", sorted(tuple(r) for r in queries()[sys.argv[1]](spark, sys.argv[2]).collect()))
"""
BIG = 200 << 20
EXPECTED = {
    "copy_round_trip": [
        ("big", BIG, "3566de3a97906edb98d004d6b947ae9b"),
        ("orders.parquet", 6, "12c500ed0b7879105fb46af0f246be87"),
    ],
    "export_partial_repeat": [("all", 1, 1), ("all but one", 1, 0)],
    "export_report": [("again", 0, 2), ("first", 2, 0)],
}


@pytest.mark.parametrize("query", EXPECTED)
def test_a_heap_that_does_not_hold_the_chunks(tmp_path, query):
    with open(tmp_path / "big", "wb") as out:
        out.truncate(BIG)
    (tmp_path / "orders.parquet").write_bytes(b"orders")
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"}
    ran = subprocess.run(
        [sys.executable, "-c", RUN, query, str(tmp_path)], cwd=REPO, env=env, capture_output=True, text=True, timeout=300
    )
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert ast.literal_eval(ran.stdout.partition("ROWS ")[2]) == EXPECTED[query]
