"""Words of whole texts as Arrow and numpy arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Odd multipliers of the hashes below; any fixed odd values do.
GOLDEN = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text's words, and the words of all texts: ``[^\\x20\\x09-\\x0D]+``.

    A null or blank text has no words.
    """
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(trimmed)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    counts[blank] = 0
    flat = lists.flatten()
    if blank.any():
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    return np.concatenate([[0], np.cumsum(counts)]), flat


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal for equal words of this array, and the distinct words."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    codes, distinct = word_codes(words)
    return distinct_hashes(distinct)[codes]


def distinct_hashes(words: pa.Array) -> np.ndarray:
    """``word_hashes`` of words that are all different."""
    if not len(words):
        return np.zeros(0, np.uint64)
    values = words.to_numpy(zero_copy_only=False).astype(object)
    return mix(pd.util.hash_array(values, categorize=False))


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles.

    ASCII letters are lower-cased.  A text of fewer than ``width`` words is one
    shingle, a text without words has none.
    """
    bounds, words = split_words(pc.ascii_lower(texts))
    hashes = word_hashes(words)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(GOLDEN)) | np.uint64(1)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled += hashes[k : k + len(rolled)] * factors[k]
    rolled = mix(rolled)
    sets = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        count = int(end - start)
        if count >= width:
            sets.append(np.unique(rolled[start : end - width + 1]))
        elif count:
            short = np.sum(hashes[start:end] * factors[:count], dtype=np.uint64) + np.uint64(count)
            sets.append(mix(np.array([short], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
