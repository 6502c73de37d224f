"""Gradient-boosted trees, fitted by Spark on all examples and applied in numpy.

Examples are small integers and come with counts.  They are replaced by the bins
of their features and counted again; each level of each tree is one pass that sums
the gradients by node, feature and bin in the tasks.  The driver holds those sums
and the trees, never examples.  Gradients are summed as whole numbers, so the same
examples give the same trees however they are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import _stored_at, map_arrow, removed
from shelfmark.session import scratch_path

# Gradients are rounded to so many parts of one.
_UNIT = 1 << 24

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def unpacked(column: pa.Array, dtype, features: int) -> np.ndarray:
    """A matrix from a column of packed rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, features)


def _below(feature: np.ndarray, cut: np.ndarray, x: np.ndarray, levels: int) -> np.ndarray:
    """The node, in heap order, that each row reaches after so many levels."""
    node, rows = np.zeros(len(x), int), np.arange(len(x))
    for _ in range(levels):
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    return node


@dataclass
class BoostedTrees:
    """Logistic boosting of trees of a fixed depth, split at quantiles of each feature."""

    features: int
    rounds: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 24
    least: float = 1.0
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def fit(self, counted: DataFrame) -> BoostedTrees | None:
        """Fit on ``counted(x, y, n)``: features as packed 32-bit integers, a label of 0 or 1, and how often.

        None if there are not both labels.
        """
        n, good = counted.agg(F.sum("n"), F.sum(F.col("n") * F.col("y"))).first()
        if not n or not 0 < good < n:
            return None
        edges = self._edges(counted)
        spark, path = counted.sparkSession, scratch_path(counted.sparkSession, "bins")
        binned = _stored_at(self._binned(counted, edges).groupBy("x", "y").agg(F.sum("n").alias("n")), path)
        share = np.clip(good / n, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        grown: list[Tree] = []  # with bins for cuts
        for _ in range(self.rounds):
            grown.append(self._grow(binned, grown, edges))
        removed(spark, path)
        # A cut at the last bin has all rows to its left.
        ends = [np.append(e, np.full(self.bins + 1 - len(e), np.inf)) for e in edges]
        self.trees = [(f, np.array([ends[own][k] for own, k in zip(f, cut)]), leaves) for f, cut, leaves in grown]
        return self

    def _edges(self, counted: DataFrame) -> list[np.ndarray]:
        """The quantiles of each feature over all examples."""
        features = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, n = unpacked(batch.column("x"), "<i4", features), batch.column("n").to_numpy()
                for f in range(features):
                    values, own = np.unique(x[:, f], return_inverse=True)
                    often = np.bincount(own, n, len(values)).astype(np.int64)
                    columns = [np.full(len(values), f, np.int32), values.astype(np.int32), often]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["f", "v", "n"])

        values = map_arrow(counted.select("x", "n"), run, "f int, v int, n long").groupBy("f", "v").agg(F.sum("n").alias("n"))
        at = F.array(*[F.lit(k / self.bins) for k in range(1, self.bins)])
        found = dict(values.groupBy("f").agg(F.percentile("v", at, F.col("n")).alias("q")).collect())
        return [np.unique(found[f]) for f in range(features)]

    def _binned(self, counted: DataFrame, edges: list[np.ndarray]) -> DataFrame:
        """``x, y, n`` with a byte for each feature, the number of edges below it."""
        features = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = unpacked(batch.column("x"), "<i4", features)
                bins = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)], axis=1)
                packed = pa.array([row.tobytes() for row in bins.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([packed, batch.column("y"), batch.column("n")], names=["x", "y", "n"])

        return map_arrow(counted.select("x", "y", "n"), run, "x binary, y int, n long")

    def _sums(self, binned: DataFrame, grown: list[Tree], feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        """Gradient and curvature by node of a level, feature and bin."""
        features, depth, width, start = self.features, self.depth, self.bins + 1, self.start
        shape = (2, features, 1 << level, width)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(shape, np.int64)
            for batch in batches:
                x, n = unpacked(batch.column("x"), np.uint8, features), batch.column("n").to_numpy()
                margin = np.full(len(x), start)
                for own, at, leaves in grown:
                    margin += leaves[_below(own, at, x, depth) - (len(leaves) - 1)]
                chance = 1 / (1 + np.exp(-margin))
                node = _below(feature, cut, x, level) - ((1 << level) - 1)
                parts = chance - batch.column("y").to_numpy(), chance * (1 - chance)
                for k, part in enumerate(parts):
                    whole = np.rint(part * _UNIT) * n  # whole numbers below 2^53, so their sums are exact
                    for f in range(features):
                        own = np.bincount(node * width + x[:, f], whole, shape[2] * width)
                        sums[k, f] += own.astype(np.int64).reshape(shape[2:])
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

        # A row for each task, of a size that does not depend on the input.
        rows = map_arrow(binned, run, "sums binary").collect()
        return sum((np.frombuffer(r["sums"], np.int64).reshape(shape) for r in rows), np.zeros(shape, np.int64)) / _UNIT

    def _grow(self, binned: DataFrame, grown: list[Tree], edges: list[np.ndarray]) -> Tree:
        """Complete binary tree in heap order; a node without a gain sends all to the left."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, int), np.full(inner, self.bins)
        leaves = np.zeros(inner + 1)
        for level in range(self.depth):
            sums = self._sums(binned, grown, feature, cut, level)
            for node in range(1 << level):
                at, best = (1 << level) - 1 + node, 1e-9
                g, h = sums[:, 0, node].sum(axis=1)
                sides = (g, h), (0.0, 0.0)
                for f in range(self.features):
                    gl, hl = np.cumsum(sums[:, f, node], axis=1)[:, : len(edges[f])]
                    gain = gl**2 / (hl + self.least) + (g - gl) ** 2 / (h - hl + self.least) - g**2 / (h + self.least)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[at], cut[at] = float(gain[k]), f, k
                        sides = (gl[k], hl[k]), (g - gl[k], h - hl[k])
                if level == self.depth - 1:
                    leaves[2 * node : 2 * node + 2] = [-self.rate * a / (b + self.least) for a, b in sides]
        return feature, cut, leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class."""
        x = np.asarray(x, float)
        margin = np.full(len(x), self.start)
        for feature, cut, leaves in self.trees:
            margin += leaves[_below(feature, cut, x, self.depth) - (len(leaves) - 1)]
        return 1 / (1 + np.exp(-margin))
