"""The model of four-grams in passes: the same scores however the work is cut, and little on disk."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from shelfmark.llm import four_grams, quality
from shelfmark.session import shared_folder
from tests.llm.test_quality_model import plain_verdicts


def texts_with_common_words(count, words):
    rng = random.Random(31)
    pick = lambda: "the" if rng.random() < 0.3 else f"w{int(rng.paretovariate(0.6)) % 5000}"
    texts = [" ".join(pick() for _ in range(words)) for _ in range(count)]
    return texts + [texts[0] + " the the", "the", "* the *", "  ", None]


@pytest.mark.parametrize(
    "sizes",
    [
        four_grams.Sizes(),
        four_grams.Sizes(slice_words=500, pass_words=1000, passes=3, bucket_words=700, hot_words=400, range_words=2000, answer_turns=2),
        four_grams.Sizes(pass_words=2000, passes=2, hot_words=10**9),
    ],
)
def test_scores_do_not_depend_on_how_the_work_is_cut(spark, sizes):
    rows = [(k, t, None) for k, t in enumerate(texts_with_common_words(60, 100))]
    wanted = plain_verdicts(rows)
    docs = spark.createDataFrame(rows, "id long, text string, lang string").repartition(3)
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")
    got = {r.id: r for r in docs.select("id", key).join(quality.perplexities(docs.select(key, "text"), sizes), "t").collect()}
    assert got.keys() == {d for d, (_, scores) in wanted.items() if scores is not None}
    for d, row in got.items():
        assert row.log_ppl == pytest.approx(wanted[d][1][0], abs=1.1e-3)
        assert row.log_ppl_words == pytest.approx(wanted[d][1][1], abs=1.1e-3)


def test_scratch_tables_take_few_bytes_a_word(spark, monkeypatch):
    rng = random.Random(32)
    rows = [(k, " ".join(f"w{int(rng.paretovariate(0.5)) % 9000}" for _ in range(400))) for k in range(300)]
    docs = spark.createDataFrame(rows, "t long, text string")
    folder, write, sizes = shared_folder(spark).removeprefix("file:"), DataFrameWriter.parquet, []

    def held():
        return sum(os.path.getsize(os.path.join(path, f)) for path, _, files in os.walk(folder) for f in files)

    def noted(self, *args, **kwargs):
        write(self, *args, **kwargs)
        sizes.append(held())

    before = held()
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    assert quality.perplexities(docs).count() == 300
    assert max(sizes) - before < 16 * 300 * 400


def test_smaller_pieces_do_not_outgrow_their_positions(spark, monkeypatch):
    rng = random.Random(33)
    rows = [(k, " ".join(f"w{int(rng.paretovariate(0.8)) % 20000}" for _ in range(400))) for k in range(300)]
    docs = spark.createDataFrame(rows, "t long, text string").coalesce(1)
    dealt, sizes = four_grams.dealt, []

    def noted(*args):
        out = dealt(*args)
        sizes.append(out.agg(F.count("body"), F.sum(F.length("body"))).first())
        return out

    monkeypatch.setattr(four_grams, "dealt", noted)
    for words in (60_000, 1_000):
        four_grams.text_costs(docs, quality.coded_words, four_grams.Sizes(passes=1, bucket_words=words))
    (few, large, *_), (many, small, *_) = sizes[0], sizes[2]
    assert many >= 50 * few
    assert small < 1.15 * large


def test_numbers_are_packed_and_ranked_whole():
    rng = np.random.default_rng(5)
    arrays = [np.zeros(0, np.int64), np.arange(300), rng.integers(0, 1 << 63, 1000).astype(np.uint64), np.array([1 << 40])]
    for a, b in zip(arrays, four_grams.unpack(four_grams.pack(*arrays)), strict=True):
        assert a.astype(np.uint64).tolist() == b.tolist()
    for top in (50, 1 << 40):
        a, b = rng.integers(0, top, 2000), rng.integers(0, top, 2000) // 7
        codes, at = four_grams.ranked(a, b, (top, top))
        pairs = sorted(set(zip(a.tolist(), b.tolist())))
        assert [pairs[c] for c in codes] == list(zip(a.tolist(), b.tolist()))
        assert [(int(a[k]), int(b[k])) for k in at] == pairs
