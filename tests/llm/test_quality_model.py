"""The quality verdict against a plain version, and planted texts of each kind that it should reject."""

import math
import random
import re
from collections import Counter

import pytest
import xxhash

from shelfmark.llm import quality
from tests.llm.helpers import clashing, documents
from tests.llm.test_corpus_operators import brute_base, fluent_texts


def words_of(text):
    return re.findall(r"[^\W_]+|[^\w\s]+|_+", text.lower())


def discounts(counts):
    n = [max(1, sum(1 for c in counts if c == k)) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return [min(max(x, low), high) for x, low, high in zip(d, (0.1, 0.2, 0.3), (0.95, 1.9, 2.85))]


class Plain:
    """Interpolated modified Kneser-Ney of four-grams, one dictionary an order."""

    def __init__(self, texts, vocabulary):
        four = Counter(g for text in texts for g in self.grams(text))
        self.vocabulary = vocabulary
        self.counts = {4: four}
        for n in (3, 2, 1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut = {n: discounts(list(c.values())) for n, c in self.counts.items()}
        self.sums = {n: Counter() for n in self.counts}
        self.left = {n: Counter() for n in self.counts}
        for n, counts in self.counts.items():
            for g, c in counts.items():
                self.sums[n][g[:-1]] += c
                self.left[n][g[:-1]] += self.cut[n][min(c, 3) - 1]

    @staticmethod
    def grams(text):
        words = [None] * 3 + words_of(text)
        return [tuple(words[k : k + 4]) for k in range(len(words) - 3)]

    def chance(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (self.vocabulary + 1)
        below = self.chance(gram[1:])
        total = self.sums[n][gram[:-1]]
        if not total:
            return below
        c = self.counts[n][gram]
        return (c - (self.cut[n][min(c, 3) - 1] if c else 0) + self.left[n][gram[:-1]] * below) / total


def densest(scores):
    scores = sorted(scores)

    def q(k):
        at = k / 200 * (len(scores) - 1)
        low = math.floor(at)
        return scores[low] + (at - low) * (scores[min(low + 1, len(scores) - 1)] - scores[low])

    wide, low = min((q(k + 100) - q(k), q(k)) for k in range(101))
    return low + wide / 2, wide / 2


def plain_verdicts(rows):
    """doc_id to (kept, log_ppl, log_ppl_words) of (doc_id, text, lang) rows with different texts."""
    half = {d: xxhash.xxh64((t or "").encode(), seed=42).intdigest() % 2 for d, t, _ in rows}
    vocabulary = len({w for _, t, _ in rows for w in words_of(t or "")})
    models = [Plain([t for d, t, _ in rows if t and half[d] == h], vocabulary) for h in (0, 1)]
    scores, failed, words = {}, {}, {}
    for d, t, _ in rows:
        base = brute_base(t)
        failed[d], words[d] = base[0] < 50 or 100 * base[4] > 50 * base[0], base[0]
        grams = Plain.grams(t or "")
        if not grams:
            scores[d] = None
            continue
        model = models[1 - half[d]]
        lettered = [g for g in grams if re.search(r"[^\W_]", g[-1])]
        count = max(1, len(lettered))
        scores[d] = (-sum(math.log(model.chance(g)) for g in grams) / count, -sum(math.log(model.chance(g[-1:])) for g in lettered) / count)
    out, bands = {}, {}
    fine = [d for d in scores if scores[d] and not failed[d]]
    langs = {d: lang for d, _, lang in rows}
    for lang in set(langs.values()):
        own = [d for d in fine if langs[d] == lang]
        if own:
            for at, least in ((0, quality.LEAST_SPREAD), (1, quality.LEAST_BELOW)):
                middle, half_width = densest([scores[d][at] for d in own])
                if len(own) < quality.FEW:
                    half_width = densest([scores[d][at] for d in fine])[1]
                bands[lang, at] = middle, max(least, quality.SPREAD * half_width)
    for d in scores:
        if scores[d] is None or failed[d]:
            out[d] = (False, scores[d])
            continue
        wider = math.sqrt(1 + quality.SHORT_WORDS / words[d])
        upper, lower = bands[langs[d], 0], bands[langs[d], 1]
        out[d] = (scores[d][0] <= upper[0] + wider * upper[1] and scores[d][1] >= lower[0] - wider * lower[1], scores[d])
    return out


@pytest.fixture(scope="module")
def planted():
    """Fluent texts of two languages, with texts of each kind that is to go."""
    rng = random.Random(21)
    fluent = fluent_texts(rng, 150) + [t.replace("w", "m") for t in fluent_texts(rng, 60)]
    rows = [(k, t, "en" if k < 150 else "fr") for k, t in enumerate(fluent)]
    bad = [" ".join(rng.sample(t.split(), 200)) for t in fluent[:6]]
    bad += ["$$$ ".join(t.split()[:120]) for t in fluent[6:12]]
    bad += [" | ".join(rng.sample(t.split(), 120)) for t in fluent[12:18]]
    bad += [" ".join("".join(rng.choices("qxzjkv", k=6)) for _ in range(120)) for _ in range(6)]
    rows += [(1000 + k, t, "en") for k, t in enumerate(bad)]
    # Near copies of fluent texts, which are no worse than these.
    rows += [(2000 + k, t + " w1 w2", "en") for k, t in enumerate(fluent[20:30])]
    return rows + [(3000, None, "en"), (3001, "", None), (3002, "! " * 60, "fr"), (3003, "w1 " * 80, "en")]


def test_the_verdict_equals_a_plain_one(spark, planted):
    wanted = plain_verdicts(planted)
    got = {r.doc_id: r for r in quality.quality(clashing(documents(spark, *planted))).collect()}
    assert got.keys() == wanted.keys()
    for d, (kept, scores) in wanted.items():
        assert got[d].kept == kept, (d, got[d], scores)
        if scores is not None:
            assert got[d].log_ppl == pytest.approx(scores[0], abs=2e-3)
            assert got[d].log_ppl_words == pytest.approx(scores[1], abs=2e-3)


def test_planted_texts_go_and_copies_stay(spark, planted):
    kept = {r.doc_id for r in quality.good_documents(documents(spark, *planted)).collect()}
    assert not [d for d in kept if 1000 <= d < 2000 or d >= 3000]
    assert len([d for d in kept if d < 210]) >= 0.95 * 210
    assert {d for d, _, _ in planted if 2000 <= d < 3000} <= kept


def test_few_common_words_fall_below_the_band(spark):
    rng = random.Random(22)
    common = [f"c{k}" for k in range(6)]
    normal = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(3000)}" for _ in range(200)) for _ in range(150)]
    # In orders of their own, so that no three words come twice often enough to fail the base rules.
    stuffed = [" ".join(rng.choices(common, k=55)) for _ in range(5)]
    rows = [(k, t, "en") for k, t in enumerate(normal + stuffed)]
    got = {r.doc_id: r for r in quality.quality(documents(spark, *rows)).collect()}
    judged = [got[150 + k] for k in range(5) if not got[150 + k].base_failed]
    assert judged and not [r for r in judged if r.kept]
    assert sum(got[k].kept for k in range(150)) >= 143


def test_signs_are_not_counted_as_words(spark):
    rng = random.Random(23)
    fluent = fluent_texts(rng, 60)
    rows = [(k, t, "en") for k, t in enumerate(fluent)] + [(100 + k, t.replace(" ", " *** "), "en") for k, t in enumerate(fluent[:8])]
    score = {r.doc_id: r.log_ppl for r in quality.quality(documents(spark, *rows)).collect()}
    assert all(score[100 + k] > score[k] for k in range(8))
