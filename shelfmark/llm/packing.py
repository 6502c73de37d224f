"""Packing token sequences: minimum bin slack on counts of lengths.

Documents are cut at multiples of the capacity.  How many pieces of each length
there are, at most ``capacity`` numbers, is all the plan needs: for the longest
remaining piece a bitset subset-sum finds the lengths that fill the rest of the
window closest, tracked back to a count for each length, and the pattern is
applied as often as the counts allow.  What slack is left takes the front of one
more piece, whose rest goes back; the last window is cut at powers of two, which
need no padding.  Pieces find their place from their length and rank alone, so only
the few columns that give these are shuffled: a piece has its checksum before, and
only pieces that a window cuts meet their ids again.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, stored, table, text_slices
from shelfmark.llm.registry import query
from shelfmark.llm.tokens import word_tokenizer

CAPACITY = 4096
END = 2

# A step (first rank, pieces per window, windows, first sequence, offset, cut, rank of the rest):
# ``cut`` 0 places whole pieces, else the first ``cut`` ids, and the rest is a piece again.
Step = tuple[int, int, int, int, int, int, int]


def best_fill(counts: np.ndarray, space: int) -> dict[int, int]:
    """How many of each length to take for the largest sum up to ``space``."""
    reach, trail, full = 1, [], (1 << (space + 1)) - 1
    for length in range(min(space, len(counts) - 1), 0, -1):
        left = min(int(counts[length]), space // length)
        size = 1
        while left > 0:
            take = min(size, left)
            trail.append((reach, length, take))
            reach |= (reach << (length * take)) & full
            left -= take
            size *= 2
        if reach >> space & 1:
            break
    target, taken = reach.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(trail):
        if not before >> target & 1:
            target -= length * take
            taken[length] += take
    return dict(taken)


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[Step]]:
    """The steps of each length that place all pieces of these lengths, in order of rank."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    total, used = left.copy(), np.zeros(capacity + 1, np.int64)
    steps: dict[int, list[Step]] = defaultdict(list)
    sequence = 0

    def place(length: int, per: int, windows: int, offset: int, cut: int = 0) -> None:
        rest = 0
        if cut:
            rest = int(total[length - cut])
            total[length - cut] += windows
            left[length - cut] += windows
        steps[length].append((int(used[length]), per, windows, sequence, offset, cut, rest))
        used[length] += per * windows
        left[length] -= per * windows

    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        taken = best_fill(left, capacity - longest)
        left[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        slack = capacity - sum(length * n for length, n in taken.items())
        spare = left.copy()
        for length, n in taken.items():
            spare[length] -= n
        if slack and not spare.any():
            filled = capacity - slack
            sizes = [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
            offset = 0
            for length in sorted(taken, reverse=True):
                for _ in range(taken[length]):
                    rest = length
                    while rest:
                        room = sizes[0] - offset
                        if rest <= room:
                            place(rest, 1, 1, offset)
                            offset, rest = offset + rest, 0
                        else:
                            place(rest, 1, 1, offset, cut=room)
                            offset, rest = sizes[0], rest - room
                        if offset == sizes[0]:
                            sizes, offset, sequence = sizes[1:], 0, sequence + 1
            continue
        need = dict(taken)
        cut = int(np.flatnonzero(spare)[-1]) if slack else 0
        if cut:
            need[cut] = need.get(cut, 0) + 1
        windows = min(int(left[length]) // n for length, n in need.items())
        offset = 0
        for length in sorted(taken, reverse=True):
            place(length, taken[length], windows, offset)
            offset += length * taken[length]
        if cut:
            place(cut, 1, windows, offset, cut=slack)
        sequence += windows
    return dict(steps)


def places(steps: dict[int, list[Step]], starts: dict[int, list[int]], length: int, rank: int):
    """``(start in piece, length, sequence, offset)`` of the parts of one piece."""
    at = 0
    while True:
        own = steps[length]
        first, per, _, base, offset, cut, rest = own[int(np.searchsorted(starts[length], rank, "right")) - 1]
        window, slot = divmod(rank - first, per)
        if not cut:
            yield at, length, base + window, offset + slot * length
            return
        yield at, cut, base + window, offset
        at, length, rank = at + cut, length - cut, rest + window


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4"))


def tokenized(docs: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id`` and packed ids of each row, with the checksums of its pieces and their ranks among those of its task."""
    schema = "uid long, part int, doc_id long, n_tokens long, ids binary, crcs array<long>, full_rank long, rest int, rest_rank long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        part = TaskContext.get().partitionId()
        seen, full, row = np.zeros(capacity, np.int64), 0, 0
        for batch in text_slices(batches):
            bounds, flat = encoder.texts(batch.column("text"))
            sizes = np.diff(bounds) + 1
            rests, fulls = sizes % capacity, sizes // capacity
            ranks = np.empty(len(sizes), np.int64)
            for k, rest in enumerate(rests.tolist()):
                ranks[k] = seen[rest]
                seen[rest] += 1
            last = np.array([end], flat.dtype)
            texts = [np.concatenate([flat[a:b], last]) for a, b in zip(bounds[:-1], bounds[1:])]
            crcs = [[_checksum(ids[k : k + capacity]) for k in range(0, len(ids), capacity)] for ids in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((part << 40) + row + np.arange(len(sizes), dtype=np.int64)),
                    pa.array(np.full(len(sizes), part, np.int32)),
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes),
                    pa.array([ids.tobytes() for ids in texts], pa.binary()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(full + np.cumsum(fulls) - fulls),
                    pa.array(rests.astype(np.int32)),
                    pa.array(ranks),
                ],
                names=["uid", "part", "doc_id", "n_tokens", "ids", "crcs", "full_rank", "rest", "rest_rank"],
            )
            full += int(fulls.sum())
            row += len(sizes)

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece.

    ``with_ids`` adds the ids of the piece.  Every id of every row lies in one
    piece; sequences hold ``capacity`` ids, but for at most a few at the end,
    which hold a power of two, so nothing is padded.

    A null or empty text is the end id alone.  A null ``doc_id`` is passed
    through, and rows that repeat a ``doc_id`` are packed one by one.  Other
    columns are ignored.  An empty table gives no rows.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, tokenizer, end, capacity), "tokens")
    rests = tokens.groupBy("part", F.col("rest").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    fulls = tokens.groupBy("part").agg(F.sum(F.floor(F.col("n_tokens") / capacity)).alias("n"))
    fulls = fulls.select("part", F.lit(capacity).alias("size"), "n")
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each task and length: how many such pieces earlier tasks have.
    tallies = stored(
        rests.unionByName(fulls).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "tallies"
    )
    counted = tallies.filter("size > 0").groupBy("size").agg(F.sum("n").alias("n")).filter("n > 0").collect()
    plan = pack({r["size"]: r["n"] for r in counted}, capacity)
    steps = spark.sparkContext.broadcast(plan)  # at most ``capacity`` lengths
    full_base = tallies.filter(F.col("size") == capacity).select("part", F.col("base").alias("full_base"))
    bases = tallies.filter(F.col("size") < capacity).join(full_base, "part")
    bases = bases.select("part", F.col("size").alias("rest"), F.col("base").alias("rest_base"), "full_base")
    # The tallies grow with the tasks, so they are not broadcast.
    ranked = (
        tokens.drop("ids")
        .join(bases.hint("merge"), ["part", "rest"])
        .withColumn("rest_rank", F.col("rest_rank") + F.col("rest_base"))
        .withColumn("full_rank", F.col("full_rank") + F.col("full_base"))
    )
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = steps.value
        starts = {length: [s[0] for s in own] for length, own in plan.items()}
        columns = ("uid", "doc_id", "n_tokens", "crcs", "full_rank", "rest", "rest_rank")
        for batch in batches:
            found: list[tuple] = []
            for uid, doc, size, crcs, full_rank, rest, rest_rank in zip(*(batch.column(c).to_pylist() for c in columns)):
                pieces = [(k * capacity, capacity, full_rank + k) for k in range(size // capacity)]
                if rest:
                    pieces.append((size - rest, rest, rest_rank))
                for (first, length, rank), crc in zip(pieces, crcs):
                    for at, part, sequence, offset in places(plan, starts, length, rank):
                        found.append((doc, first + at, part, crc if part == length else None, size, sequence, offset, uid))
            names = [*(f.split()[0] for f in out.split(", ")), "uid"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=names)

    small = ranked.select("uid", "doc_id", "n_tokens", "crcs", "full_rank", "rest", "rest_rank")
    placed = stored(map_arrow(small, place, out + ", uid long"), "placed")
    ids = tokens.select("uid", "rest", "ids")
    if with_ids:
        return _with_ids(placed, ids, out)
    # Only what is left over of windows is cut: stored by itself, Spark knows how little it is before it joins.
    cut = stored(placed.filter("ids_crc32 is null"), "cut")
    cut_lengths = [length for length, own in plan.items() if any(step[5] for step in own)]
    checked = _with_ids(cut, ids.filter(F.col("rest").isin(cut_lengths)), out).drop("ids")
    return placed.filter("ids_crc32 is not null").drop("uid").unionByName(checked)


def _with_ids(placed: DataFrame, ids: DataFrame, out: str) -> DataFrame:
    """``placed`` with the ids of each row, and their checksum, from ``ids(uid, ids)`` of whole texts."""
    names = [f.split()[0] for f in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "ids"):
            own = []
            for packed, size, start, length in zip(*(batch.column(c) for c in ("ids", "doc_tokens", "start", "length"))):
                raw, size, start, length = packed.as_buffer(), size.as_py(), start.as_py(), length.as_py()
                whole = np.frombuffer(raw, np.uint16 if len(raw) == 2 * size else np.uint32)
                own.append(whole[start : start + length].astype(np.int32))
            crcs = pa.array([_checksum(x) for x in own], pa.int64())
            columns = [crcs if n == "ids_crc32" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.list_(pa.int32()))], names=[*names, "ids"])

    return map_arrow(placed.join(ids.select("uid", "ids"), "uid").select(*names, "ids"), run, out + ", ids array<int>")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op3_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
