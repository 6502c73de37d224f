"""Modified Kneser-Ney smoothing in memory, to compare the joined one with."""

from __future__ import annotations

import numpy as np

from shelfmark.llm.quality import ORDER, discounts

BITS = 6


def four_grams(classes: np.ndarray) -> np.ndarray:
    """The packed four-gram that starts at each place."""
    wide = classes.astype(np.uint32)
    count = max(0, len(wide) - ORDER + 1)
    grams = np.zeros(count, np.uint32)
    for k in range(ORDER):
        grams = (grams << np.uint32(BITS)) | wide[k : k + count]
    return grams


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, 2 and more, from the counts of counts."""
    return discounts(*(int((counts == k).sum()) for k in (1, 2, 3, 4)))


class Model:
    """The same smoothing in memory, over packed n-grams of 64 symbols: what ``probabilities`` is compared with.

    Per order the sorted n-grams with their log probabilities, and contexts with log back-off weights.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        grams, counts = grams[order].astype(np.uint32), counts[order].astype(np.float64)
        by_order = {ORDER: (grams, counts)}
        for n in range(ORDER - 1, 0, -1):
            # Continuation counts: in how many n+1-grams the n-gram ends.
            by_order[n] = tuple(np.unique(by_order[n + 1][0] & np.uint32((1 << BITS * n) - 1), return_counts=True))
        self.grams: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.backoffs: list[np.ndarray] = []
        lower = np.full(1 << BITS, 1.0 / (1 << BITS))
        for n in range(1, ORDER + 1):
            keys, values = by_order[n]
            values = values.astype(np.float64)
            d = _discounts(values)[np.minimum(values, 3).astype(int) - 1] if len(values) else values
            context, where = np.unique(keys >> np.uint32(BITS), return_inverse=True)
            total = np.bincount(where, values, len(context))
            weight = np.bincount(where, d, len(context)) / np.maximum(total, 1)
            if n == 1:
                below = lower[keys]
            else:
                below = np.exp(self._lookup(n - 1, keys & np.uint32((1 << BITS * (n - 1)) - 1)))
            chance = (values - d) / total[where] + weight[where] * below if len(keys) else values
            self.grams.append(keys)
            self.logs.append(np.log(chance).astype(np.float32))
            self.contexts.append(context)
            self.backoffs.append(np.log(np.maximum(weight, 1e-12)).astype(np.float32))

    def _lookup(self, n: int, keys: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.full(len(keys), -BITS * np.log(2.0), np.float32)
        own = self.grams[n - 1]
        if not len(own):
            return self._lookup(n - 1, keys & np.uint32((1 << BITS * (n - 1)) - 1))
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        logs = self.logs[n - 1][at]
        missed = np.flatnonzero(own[at] != keys)
        if len(missed):
            rest = keys[missed]
            logs[missed] = self._lookup(n - 1, rest & np.uint32((1 << BITS * (n - 1)) - 1))
            contexts = self.contexts[n - 1]
            before = rest >> np.uint32(BITS)
            at = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
            seen = contexts[at] == before
            logs[missed[seen]] += self.backoffs[n - 1][at[seen]]
        return logs

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last class of each four-gram."""
        return self._lookup(ORDER, grams)
