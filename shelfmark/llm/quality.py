"""Quality rules: base counts, and perplexity under a modified Kneser-Ney model of words.

The model is over four-grams of words, each a 64-bit hash, and is never held whole:
``four_grams`` counts and scores it in sorted arrays, bucket by bucket and pass by
pass, so neither the driver nor a task nor the disk has all of a model that grows
with the corpus.  ``probabilities`` gives the same chances of counted four-grams as
a table, by joins.  Texts are dealt into two halves by their hash and each is scored by the counts of
the other half: scored by its own, a text of words in random order would look
fluent, as every n-gram that occurs once follows a context that occurs once.

Signs are words for the model, but the mean is taken over words with a letter or
digit only: signs strewn between words raise a text's perplexity, they never
dilute it.  Each language has a band.  Above its upper bound a text reads like no
other of its language.  The lower bound is held against the perplexity of single
words, without their order: texts that repeat the commonest words fall below it,
while copies of a text in the other half, whose four-grams are all known, do not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import _stored_at, ddl, map_arrow, removed, stored, table, text_slices
from shelfmark.llm.four_grams import HALVES, Sizes, discounts, ranked, text_costs
from shelfmark.llm.registry import query
from shelfmark.llm.words import distinct_hashes, split_words, word_codes, word_hashes
from shelfmark.session import scratch_path

ORDER = 4
SYMBOLS = b"#*$%&|<>"
# A document is rejected beyond so many half-widths of the shortest interval that holds half of
# its language's scores (2.7 standard deviations if normal), and at least this; wider for short
# texts, whose means vary more: 1.4 times at 50 words.
SPREAD, LEAST_SPREAD, SHORT_WORDS = 4.0, 0.25, 50
# The lower bound is at least so far below the middle, a factor of e in perplexity.
LEAST_BELOW = 1.0
# Languages with fewer documents take the width of all documents.
FEW = 100

# The words of a four-gram, last one last, and the counts or probabilities by half of the texts.
WORDS = [f"w{k}" for k in range(ORDER)]

# Scripts written without spaces are cut into characters; runs of signs are words of their own.
_PIECES = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|[^\pL\pM\pN\s]+"


def model_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and hashes of the words that the model sees, in lower case."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    bounds, words = split_words(pc.replace_substring_regex(texts, f"({_PIECES})", r" \1 "))
    return bounds, word_hashes(words).view(np.int64)


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of ``model_words``: bounds and numbers, and of each number the hash and whether it has a letter or digit.

    Words between white space are cut into pieces once each, however often they come.
    """
    bounds, words = split_words(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    codes, distinct = word_codes(words)
    # Words of ASCII letters and digits are one piece, and need no pattern.
    odd = pc.invert(pc.ascii_is_alnum(distinct))
    spaced = pc.replace_substring_regex(distinct.filter(odd), _PIECES, r" \0 ")
    cuts, pieces = split_words(pc.replace_with_mask(distinct, odd, spaced))
    piece_codes, hashed = word_codes(pieces)
    letters = pc.ascii_is_alnum(hashed).to_numpy(zero_copy_only=False).copy()
    rest = np.flatnonzero(~letters)
    letters[rest] = pc.match_substring_regex(hashed.take(pa.array(rest)), r"[\pL\pM\pN]").to_numpy(zero_copy_only=False)
    sizes = np.diff(cuts)[codes]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    within = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    return ends[bounds], piece_codes[np.repeat(cuts[codes], sizes) + within], distinct_hashes(hashed), letters


def probabilities(grams: DataFrame, folders: list[str]) -> DataFrame:
    """``w0, w1, w2, w3, p0, p1, u0, u1`` of ``grams(w0, w1, w2, w3, n0, n1)``, distinct four-grams with their counts in each half.

    ``p0`` and ``p1`` are the chances of the last word after the others under the
    model of each half, also for four-grams that this half lacks; ``u0`` and ``u1``
    are those of the word by itself.  Scratch tables
    are noted in ``folders``; they are read until the result has been.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        folders.append(scratch_path(df.sparkSession, name))
        return _stored_at(df, folders[-1])

    by_order = {ORDER: kept(grams, f"grams{ORDER}")}
    for n in range(ORDER - 1, 0, -1):
        # Continuation counts: in how many n+1-grams the n-gram ends.
        ends = [F.count_if(F.col(f"n{h}") > 0).alias(f"n{h}") for h in HALVES]
        by_order[n] = kept(by_order[n + 1].groupBy(*WORDS[ORDER - n :]).agg(*ends), f"grams{n}")
    below = None
    for n in range(1, ORDER + 1):
        own, context, rest = by_order[n], WORDS[ORDER - n : -1], WORDS[ORDER - n + 1 :]
        often = own.agg(
            F.count(F.lit(1)), *[F.count_if(F.col(f"n{h}") == k) for h in HALVES for k in (1, 2, 3, 4)]
        ).first()
        cut = {}
        for h in HALVES:
            d = discounts(*often[1 + 4 * h : 5 + 4 * h]).tolist()
            count = F.col(f"n{h}")
            cut[h] = F.when(count == 0, 0.0).when(count == 1, d[0]).when(count == 2, d[1]).otherwise(d[2])
        sums = [x for h in HALVES for x in (F.sum(f"n{h}").alias(f"all{h}"), F.sum(cut[h]).alias(f"cut{h}"))]
        if n == 1:
            own = own.crossJoin(own.agg(*sums))
            lower = {h: F.lit(1.0 / (often[0] + 1)) for h in HALVES}  # one more for a word never seen
        else:
            own = own.join(own.groupBy(*context).agg(*sums), context)
            renamed = below.select(*rest, *[F.col(f"p{h}").alias(f"q{h}") for h in HALVES], *[f"u{h}" for h in HALVES])
            own = own.join(renamed, rest)
            lower = {h: F.col(f"q{h}") for h in HALVES}
        chance = [
            F.when(F.col(f"all{h}") > 0, (F.col(f"n{h}") - cut[h] + F.col(f"cut{h}") * lower[h]) / F.col(f"all{h}"))
            .otherwise(lower[h])
            .alias(f"p{h}")
            for h in HALVES
        ]
        below = own.select(*WORDS[ORDER - n :], *chance, *([] if n == 1 else [f"u{h}" for h in HALVES]))
        if n == 1:
            below = below.withColumns({f"u{h}": F.col(f"p{h}") for h in HALVES})
    return below


def perplexities(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """``t, log_ppl, log_ppl_words`` of each ``t`` of ``docs(t, text)`` that has words, by the counts of the other half.

    Both are means over the words with a letter or digit: the first of all
    four-grams, the second of these words by themselves.
    """
    costs, folders = text_costs(docs, coded_words, sizes)
    # A text that is there several times has its sums as often, which the means do not show.
    sums = costs.groupBy("t").agg(*[F.sum(c).alias(c) for c in ("all", "single", "words")])
    words = F.greatest("words", F.lit(1)) * 1e6
    each = [F.round(F.col(c) / words, 3).alias(name) for c, name in (("all", "log_ppl"), ("single", "log_ppl_words"))]
    out = stored(sums.select("t", *each), "perplexities")
    for folder in folders:
        removed(docs.sparkSession, folder)
    return out


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _marked_per_text(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(marked), bounds))


def _repeated_words(codes: np.ndarray, bounds: np.ndarray, distinct: int) -> np.ndarray:
    """Words in three-word windows that their text has twice or more."""
    count = len(codes) - 2
    if count < 1:
        return np.zeros(len(bounds) - 1, np.int64)
    pairs, _ = ranked(codes[:-2], codes[1:-1], (distinct, distinct))
    windows, _ = ranked(pairs, codes[2:], (count, distinct))
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = texts[:-2] == texts[2:]
    place = np.flatnonzero(whole)
    own, _ = ranked(texts[place], windows[place], (len(bounds) - 1, count))
    often = np.bincount(own)
    start = place[often[own] > 1]
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[start + k] = True
    return _marked_per_text(covered, bounds)


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base features of whole texts; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds, words = split_words(texts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    codes, distinct = word_codes(words)
    raw = np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8)
    at = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    line_texts = np.repeat(np.arange(len(texts)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    line_codes, _ = word_codes(flat)
    kept = (line_texts[full].astype(np.int64) << 32) | line_codes[full]
    first = np.unique(kept) >> 32
    return {
        "n_words": np.diff(bounds),
        "word_chars": _per_text(chars, bounds),
        "n_symbols": _marked_per_text(marks[raw], at.astype(np.int64)),
        "n_dup_lines": np.bincount(line_texts[full], minlength=len(texts)) - np.bincount(first, minlength=len(texts)),
        "n_repeat_words": _repeated_words(codes, bounds, len(distinct)),
    }


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def scored(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The carried columns as ``carried_*`` with the base features, ``base_failed`` and ``log_ppl``."""
    # Equal texts have one key, and one score.
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")
    scores = perplexities(docs.select(key, "text"))
    names = [f"carried_{c}" for c in carry]
    carried = [F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)]
    picked = docs.select(*carried, key, F.col("text").alias("text"))
    schema = ", ".join([ddl(picked, [*names, "t"]), *[f"{f} long" for f in FEATURES], "base_failed boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            base = base_counts(batch.column("text"))
            failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in [*names, "t"]],
                    *[pa.array(base[f].astype(np.int64)) for f in FEATURES],
                    pa.array(failed),
                ],
                names=[*names, "t", *FEATURES, "base_failed"],
            )

    return map_arrow(picked, run, schema).join(scores, "t", "left").drop("t")


def _densest_half(scores: DataFrame, score: str, *by) -> DataFrame:
    """The middle and half-width of the shortest interval of half of the scores, and how many there are.

    Less than half of the rows elsewhere, on whichever side, cannot carry it off.
    """
    q = F.percentile(score, F.array(*[F.lit(k / 200) for k in range(201)]))
    found = scores.filter(~F.col("base_failed")).groupBy(*by).agg(q.alias("q"), F.count(score).alias("rows"))
    width = lambda k: F.get("q", k + 100) - F.get("q", k)
    halves = F.transform(F.sequence(F.lit(0), F.lit(100)), lambda k: F.struct(width(k).alias("wide"), F.get("q", k).alias("low")))
    best = found.withColumn("best", F.array_min(halves))
    return best.select(*[c for c in best.columns if c not in ("q", "best")], (F.col("best.low") + F.col("best.wide") / 2).alias("middle"), (F.col("best.wide") / 2).alias("half"))


def bands(scores: DataFrame, spread: float = SPREAD, least: float = LEAST_SPREAD, least_below: float = LEAST_BELOW) -> DataFrame:
    """``of, middle, above, middle_words, below``: each language's band, null being one of its own.

    The upper bound is one of four-grams, the lower bound one of single words.
    Scores are rounded to thousandths, so exact quantiles hold few values.
    """
    sides = []
    for score, middle, wide, narrowest in (("log_ppl", "middle", "above", least), ("log_ppl_words", "middle_words", "below", least_below)):
        own = _densest_half(scores, score, F.col("carried_lang").alias("of"))
        every = _densest_half(scores, score).select(F.col("half").alias("half_of_all"))
        half = F.when(F.col("rows") < FEW, F.col("half_of_all")).otherwise(F.col("half"))
        side = own.crossJoin(every).select("of", F.col("middle").alias(middle), F.greatest(F.lit(narrowest), spread * half).alias(wide))
        sides.append(side)
    upper, lower = sides[0], sides[1].withColumnRenamed("of", "of_words")
    return upper.join(lower, F.col("of").eqNullSafe(F.col("of_words"))).drop("of_words")


def judged(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    scores = stored(scored(docs, carry), "scores")
    out = scores.join(bands(scores), F.col("carried_lang").eqNullSafe(F.col("of")), "left")
    wider = F.sqrt(1 + SHORT_WORDS / F.greatest("n_words", F.lit(1)))
    fluent = F.col("log_ppl") <= F.col("middle") + wider * F.col("above")
    varied = F.col("log_ppl_words") >= F.col("middle_words") - wider * F.col("below")
    inside_band = F.coalesce(fluent & varied, F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & inside_band)


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base features, ``base_failed``, ``kept`` and both perplexities of ``docs(doc_id, text, lang)``.

    A null text is an empty one, and texts of under 50 words fail the base
    rules.  A null language has a bound of its own.  Null and repeated ids are
    passed through row by row; other columns are ignored; an empty table gives
    no rows.
    """
    out = judged(docs, ("doc_id", "lang"))
    return out.select(F.col("carried_doc_id").cast("long").alias("doc_id"), *FEATURES, "base_failed", "kept", "log_ppl", "log_ppl_words")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    out = judged(docs, tuple(docs.columns)).filter("kept")
    return out.select(*[F.col(f"`carried_{c}`").alias(c) for c in docs.columns])


@query()
def op7_perplexity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
