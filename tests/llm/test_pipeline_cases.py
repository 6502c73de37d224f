"""The pipeline's stages on nulls, blanks, repeated rows, other columns and nothing at all."""

import random

from pyspark.sql import functions as F

from tests.llm.helpers import documents
from tests.llm.test_corpus_operators import fluent_texts


def chained(spark, docs):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    return docs


def test_stages_on_odd_rows(spark):
    rng = random.Random(31)
    rows = [(k, t, rng.choice(["en", None]), rng.choice(["a", None]), len(t)) for k, t in enumerate(fluent_texts(rng, 40, words=80))]
    rows += [(500, None, "en", "a", None), (501, "", None, None, 0), (None, rows[0][1] + " x", "en", "a", 1), rows[3], rows[3]]
    df = documents(spark, *rows).withColumns({"node": F.lit(1), "part": F.lit("p"), "uid": F.lit("u")})
    pieces = chained(spark, df).collect()
    found = {r.doc_id for r in pieces}
    assert found and found <= {*range(40), None}
    assert all(0 <= r.offset and r.offset + r.length <= 4096 for r in pieces)


def test_stages_on_nothing(spark):
    assert chained(spark, documents(spark)).count() == 0
