"""Training samples without caps and chunks of alike rows."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfmark.llm import language_id, mixing, personal_data, url_filter
from tests.llm.helpers import documents


def test_alike_rows_are_dealt_in_turn(spark):
    rows = spark.range(20_000).select(F.col("id").alias("uid"), F.lit(-5).cast("long").alias("key"), F.lit(20_000).cast("long").alias("n"))
    sizes = Counter(r.chunk for r in mixing._dealt(rows).collect())
    assert sum(sizes.values()) == 20_000 and max(sizes.values()) <= mixing.CHUNK


def test_alike_rows_are_mixed_the_same_in_every_run(spark):
    rows = [(1, "five words are in here", "en", "a") for _ in range(3000)] + [(None, "three words here", "en", "b")] * 700
    df = documents(spark, *rows)
    runs = [Counter(tuple(r) for r in mixing.mix_sources(df.repartition(k)).collect()) for k in (2, 5)]
    assert runs[0] == runs[1]
    for source in (15_000, 2100):
        mine = [(key, count) for key, count in runs[0].items() if key[2] == source]
        taken = sum(key[4] * count for key, count in mine)
        assert abs(taken - mine[0][0][3]) <= 5


def test_every_language_is_learned(spark):
    rows = [(k, f"{chr(97 + k % 26)}{chr(97 + k // 26)} " * 12, f"l{k % 300:03d}") for k in range(600)]
    network = language_id.trained_network(documents(spark, *rows).filter("doc_id < 600"), documents=2, windows=1)
    assert len(network.names) > 250
    few = language_id.trained_network(documents(spark, *rows), documents=2, windows=1, languages=5)
    assert len(few.names) == 5


def test_a_repeated_row_is_learned_from_once(spark):
    base = documents(spark, (1, "the same row again and again", "en"), (2, "une autre ligne", "fr"))
    many = base.unionByName(spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("the same row again and again").alias("text"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars")))
    seen = []
    fit = language_id.Network.fit
    language_id.Network.fit = lambda self, windows, codes: seen.append(len(windows)) or self
    try:
        language_id.trained_network(many, documents=200_000)
    finally:
        language_id.Network.fit = fit
    assert seen == [2]


def test_examples_come_from_all_over_a_text():
    found = [(k, 0) for k in range(10_000)]
    picked = [k for k, _ in personal_data._some(found, 500, 7)]
    assert len(picked) == 500 and picked == sorted(picked) and picked == [k for k, _ in personal_data._some(found, 500, 7)]
    assert np.histogram(picked, 10, (0, 10_000))[0].min() > 25
    assert personal_data._some(found[:5], 500, 7) == found[:5]


def test_a_hot_url_is_learned_from_once(spark, monkeypatch):
    hot = spark.range(50_000).select(F.lit("https://example.org/es/hot").alias("url"))
    others = spark.range(40).select(F.format_string("https://a.com/fr/%d", "id").alias("url"))
    ruled = url_filter.with_rules(hot.unionByName(others))
    seen = []
    monkeypatch.setattr(url_filter, "grow", lambda rows, names: seen.append(rows.select("url", "y").collect()))
    for urls in (1000, 10):
        url_filter.trained_trees(ruled, url_filter.suffix_statistics(ruled), urls=urls)
    assert Counter(r.url for r in seen[0]).most_common(1)[0][1] == 1 and len(seen[0]) == 41
    assert len(seen[1]) < 25
