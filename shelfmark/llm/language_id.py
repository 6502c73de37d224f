"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of a
bounded sample.  Prediction cuts every text into windows, labels each byte from
both directions, and averages the bytes' probabilities over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, table, text_slices
from shelfmark.llm.registry import query

# The sample: about so many documents of each language, and so many windows of each.
TRAIN_DOCUMENTS, TRAIN_WINDOWS, TRAIN_WIDTH = 500, 12, 64
HIDDEN, STEPS, BATCH = 8, 500, 192
WIDTH, ROWS = 256, 2048
PAD = 256


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """One direction: a table of gate inputs per byte, and recurrent weights.

    Columns are update gate, reset gate and candidate.  A padding byte keeps the
    update gate shut, so the state does not change.
    """

    table: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray
    output: np.ndarray

    @classmethod
    def random(cls, rng: np.random.Generator, hidden: int, classes: int) -> Direction:
        def init(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        own = cls(
            init(PAD + 1, 3 * hidden, scale=0.3),
            init(hidden, 2 * hidden, scale=hidden**-0.5),
            init(hidden, hidden, scale=hidden**-0.5),
            init(hidden, classes, scale=hidden**-0.5),
        )
        own.shut()
        return own

    def shut(self) -> None:
        self.table[PAD] = 0
        self.table[PAD, : len(self.candidate)] = -60

    def arrays(self) -> list[np.ndarray]:
        return [self.table, self.gates, self.candidate, self.output]

    def states(self, windows: np.ndarray, steps: range):
        """Per step the state before, gates, candidate and state after."""
        h = np.zeros((len(windows), len(self.candidate)), np.float32)
        size = h.shape[1]
        for t in steps:
            inputs = self.table[windows[:, t]]
            zr = _sigmoid(inputs[:, : 2 * size] + h @ self.gates)
            z, r = zr[:, :size], zr[:, size:]
            n = np.tanh(inputs[:, 2 * size :] + (r * h) @ self.candidate)
            new = h + z * (n - h)
            yield t, h, z, r, n, new
            h = new

    def label(self, columns: np.ndarray, steps: range, logits: np.ndarray) -> None:
        """Add this direction's part to ``logits[t]`` for bytes ``columns[t]``; the gates' halving is in the weights."""
        size = len(self.candidate)
        half = np.concatenate([np.full(2 * size, 0.5), np.ones(size)]).astype(np.float32)
        inputs, gates = self.table * half, self.gates * np.float32(0.5)
        h = np.zeros((columns.shape[1], size), np.float32)
        own = np.empty((len(h), 3 * size), np.float32)
        zr = np.empty((len(h), 2 * size), np.float32)
        n = np.empty_like(h)
        for t in steps:
            np.take(inputs, columns[t], axis=0, out=own, mode="clip")
            np.matmul(h, gates, out=zr)
            zr += own[:, : 2 * size]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            np.multiply(zr[:, size:], h, out=n)
            n = n @ self.candidate
            n += own[:, 2 * size :]
            np.tanh(n, out=n)
            n -= h
            n *= zr[:, :size]
            h += n
            logits[t] += h @ self.output


def _backward(own: Direction, windows: np.ndarray, trace: list, d_logits: np.ndarray) -> list[np.ndarray]:
    """Gradients of one direction, from those of the logits, back through its steps."""
    size = len(own.candidate)
    grads = [np.zeros_like(x) for x in own.arrays()]
    d_h = np.zeros((len(windows), size), np.float32)
    for t, h, z, r, n, new in reversed(trace):
        d_h = d_h + d_logits[t] @ own.output.T
        grads[3] += new.T @ d_logits[t]
        d_n = d_h * z * (1 - n * n)
        d_z = d_h * (n - h) * z * (1 - z)
        d_rh = d_n @ own.candidate.T
        d_r = d_rh * h * r * (1 - r)
        grads[2] += (r * h).T @ d_n
        d_zr = np.concatenate([d_z, d_r], axis=1)
        grads[1] += h.T @ d_zr
        np.add.at(grads[0], windows[:, t], np.concatenate([d_zr, d_n], axis=1))
        d_h = d_h * (1 - z) + d_rh * r + d_zr @ own.gates.T
    grads[0][PAD] = 0
    return grads


class Network:
    """Both directions, the languages' names and their log shares."""

    def __init__(self, names: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.names = names
        self.ways = [Direction.random(rng, hidden, len(names)) for _ in range(2)]
        self.bias = np.zeros(len(names), np.float32)

    def chances(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities of each language at each place: (places, windows, languages)."""
        width = windows.shape[1]
        logits = np.empty((width, len(windows), len(self.names)), np.float32)
        logits[:] = self.bias
        columns = np.ascontiguousarray(windows.T).astype(np.intp)
        self.ways[0].label(columns, range(width), logits)
        self.ways[1].label(columns, range(width - 1, -1, -1), logits)
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH) -> Network:
        """Adam on the mean cross entropy of all places that are not padding."""
        rng = np.random.default_rng(17)
        width = windows.shape[1]
        orders = [range(width), range(width - 1, -1, -1)]
        params = [a for way in self.ways for a in way.arrays()] + [self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(windows), batch)
            own, wanted = windows[rows], labels[rows]
            traces = [list(way.states(own, order)) for way, order in zip(self.ways, orders)]
            logits = np.tile(self.bias, (width, batch, 1))
            for way, trace in zip(self.ways, traces):
                for t, *_, new in trace:
                    logits[t] += new @ way.output
            logits -= logits.max(axis=2, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=2, keepdims=True)
            chance[:, np.arange(batch), wanted] -= 1
            chance *= (own.T != PAD)[:, :, None] / np.float32((own != PAD).sum())
            grads = [g for way, trace in zip(self.ways, traces) for g in _backward(way, own, trace, chance)]
            grads.append(chance.sum(axis=(0, 1)))
            rate = 0.02 * min(1.0, 4 * (1 - step / (steps + 1)))
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            for way in self.ways:
                way.shut()
        return self


def _windows(raw: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of each text in windows of ``width``, padded at the end, and each window's text."""
    sizes = np.diff(bounds)
    counts = -(-sizes // width)
    text = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    start = bounds[:-1][text] + (np.arange(len(text)) - first[text]) * width
    at = start[:, None] + np.arange(width)
    windows = raw[np.minimum(at, max(0, len(raw) - 1))].astype(np.int16) if len(text) else np.zeros((0, width), np.int16)
    windows[at >= bounds[1:][text][:, None]] = PAD
    return windows, text


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return raw, np.concatenate([[0], np.cumsum(sizes)])


def in_holdout() -> Column:
    """Documents that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained_network(
    docs: DataFrame, documents: int = TRAIN_DOCUMENTS, windows: int = TRAIN_WINDOWS, languages: int | None = None
) -> Network | None:
    """A network fitted on about ``documents`` documents of each language, or none without any.

    The documents are chosen by a hash, and from each some evenly spaced windows;
    equal windows count once, so a row that is repeated is learned from once.
    ``languages`` keeps the commonest only; by default every one is learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            raw, bounds = _bytes(batch.column("text"))
            own, text = _windows(raw, bounds, TRAIN_WIDTH)
            counts = np.bincount(text, minlength=batch.num_rows)
            rank = np.arange(len(text)) - (np.cumsum(counts) - counts)[text]
            step = np.maximum(1, counts // windows)[text]
            keep = np.flatnonzero((rank % step == 0) & (rank // step < windows))
            names = batch.column("lang").take(pa.array(text[keep]))
            packed = pa.array([w.tobytes() for w in own[keep]], pa.binary())
            yield pa.RecordBatch.from_arrays([names, packed], names=["lang", "window"])

    known = docs.filter(~in_holdout() & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text")
    counted = known.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    common = (counted if languages is None else counted.limit(languages)).collect()
    if not common:
        return None
    # A literal, so that no text is shuffled to meet its language's share.
    share = F.create_map(*[F.lit(x) for row in common for x in (row["lang"], -(-row["count"] // documents))])[F.col("lang")]
    sample = known.filter(F.pmod(F.xxhash64("doc_id", "text"), share) == 0)
    rows = map_arrow(sample.select("lang", "text"), run, "lang string, window binary").distinct().toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("lang", "ascending"), ("window", "ascending")])  # the same in every run
    labels = rows.column("lang").combine_chunks().dictionary_encode()
    names = labels.dictionary.to_pylist()
    own = np.frombuffer(b"".join(rows.column("window").to_pylist()), np.int16).reshape(-1, TRAIN_WIDTH)
    codes = labels.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # As many windows of each language, so that a common one is not preferred.
    rng = np.random.default_rng(3)
    most = int(np.bincount(codes).max())
    picked = np.concatenate([rng.choice(np.flatnonzero(codes == c), most) for c in range(len(names))])
    return Network(names).fit(own[picked], codes[picked])


def predict_languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs(doc_id, text)``.

    A text that is null or has no letter is ``und`` with score 0, as is every
    text where there was nothing to learn from.  Null and repeated ids are
    passed through row by row; other columns are ignored; an empty table gives
    no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in text_slices(batches, most=1 << 21):
            texts = pc.fill_null(batch.column("text"), "")
            letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
            names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            if model is not None and letters.any():
                own = np.flatnonzero(letters)
                raw, bounds = _bytes(texts.filter(pa.array(letters)))
                windows, text = _windows(raw, bounds, WIDTH)
                sums = np.zeros((len(own), len(model.names)))
                for at in range(0, len(windows), ROWS):
                    part = windows[at : at + ROWS]
                    chance = model.chances(part)
                    chance *= (part.T != PAD)[:, :, None]
                    np.add.at(sums, text[at : at + ROWS], chance.sum(axis=0, dtype=np.float64))
                sums /= np.diff(bounds)[:, None]
                names[own] = np.array(model.names, object)[sums.argmax(axis=1)]
                scores[own] = np.minimum(sums.max(axis=1), 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", in_holdout().alias("held_out"), "text")
    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


@query()
def op5_recurrent_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_languages(docs, trained_network(docs))
