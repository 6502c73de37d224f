"""What the tests of this folder share."""

from __future__ import annotations

from pathlib import Path

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *rows):
    """A small ``documents`` table; rows are (doc_id, text) or longer."""
    full = [(*r, *[None] * (5 - len(r)))[:5] for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """``df`` with more columns, named like those the operators make on the way."""
    from pyspark.sql import functions as F

    names = ["id", "a", "b", "n", "uid", "part", "bucket", "block", "node", "component_id", "kept", "of", "size", "sha"]
    return df.withColumns({name: F.lit("x") for name in names})


def sf_table(spark, name):
    return spark.read.parquet(str(Path(SF) / f"{name}.parquet"))
