"""The trees over personal data learn from every example of every document."""

import struct
from collections import Counter

import numpy as np

from shelfmark.llm import personal_data
from shelfmark.llm.trees import BoostedTrees
from tests.llm.helpers import documents


def test_every_example_of_every_text_counts(spark):
    long = " ".join(f"call +49 30 {k:07d} or 10.0.{k % 250}.7 or 20{k:05d} 11 {k}" for k in range(400))
    texts = [f"mail n{k}@h{k % 7}.org, tel (555) 123-{k:04d}, {k} 4111 1111 1111 1111" for k in range(300)]
    rows = [*texts, long, long, texts[0], None, "", "nothing here"]
    got = Counter()
    for r in personal_data.counted_examples(documents(spark, *enumerate(rows)).repartition(3)).collect():
        got[bytes(r.x), r.y] += r.n
    asked = Counter(
        (struct.pack("<25i", *x), y) for text in {t for t in rows if t} for x, y in personal_data.examples(text)
    )
    assert sum(Counter(1 for _ in personal_data.examples(long)).values()) > 2 * 500
    assert got == asked


def plain_chances(x, y, rounds, depth, rate=0.2, bins=24, least=1.0):
    """Boosted trees on all rows, split by split."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-margin))
        g, h = chance - y, chance * (1 - chance)
        score = lambda own: g[own].sum() ** 2 / (h[own].sum() + least)
        parts = [np.ones(len(y), bool)]
        for _ in range(depth):
            split = []
            for own in parts:
                best, left = 1e-9, own
                for f, cuts in enumerate(edges):
                    for cut in cuts:
                        low = own & (x[:, f] <= cut)
                        gain = score(low) + score(own & ~low) - score(own)
                        if gain > best + 1e-6:
                            best, left = gain, low
                split += [left, own & ~left]
            parts = split
        for own in parts:
            margin[own] -= rate * g[own].sum() / (h[own].sum() + least)
    return 1 / (1 + np.exp(-margin))


def test_trees_equal_plain_ones_on_all_rows(spark):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 9, 4000), rng.integers(0, 200, 4000), rng.integers(0, 2, 4000), np.zeros(4000, int)], axis=1)
    y = (((x[:, 0] > 4) & (x[:, 1] < 70)) | ((x[:, 2] == 1) & (rng.random(4000) < 0.3))).astype(int)
    counts = Counter((struct.pack("<4i", *row), int(label)) for row, label in zip(x.tolist(), y))
    rows = [(bytearray(k), label, n) for (k, label), n in counts.items()]
    schema = "x binary, y int, n long"
    fits = [BoostedTrees(4, rounds=3).fit(spark.createDataFrame(rows, schema).repartition(k)) for k in (1, 5)]
    found = [t.predict(x) for t in fits]
    assert np.array_equal(*found)
    assert np.allclose(found[0], plain_chances(x, y, 3, 3), atol=1e-5)
    assert BoostedTrees(4).fit(spark.createDataFrame([r for r in rows if r[1]], schema)) is None
    assert BoostedTrees(4).fit(spark.createDataFrame([], schema)) is None
