"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is how often each of its documents is wanted.
The whole part of that is certain; the fractional parts are rounded in pairs:
mass, in words, moves between two documents in a random direction until one of
them is 0 or 1, which keeps the expected copies of each document and the words
of the pair.  Chunks of a source are rounded in parallel, the one document that
stays fractional in each goes up to the next level of a tree, and the last one
of a source goes to the nearer side, so a source misses its target by at most
half a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, sorted_groups, stored, table
from shelfmark.llm.registry import query
from shelfmark.operators.ranks import ranked_within
from shelfmark.llm.words import mix

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
CHUNK = 256


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Sources in order of code points, null last, weigh 3, 1, 2 and so on; each
    wants its weight's part of ``share`` times all sizes and at most ``most``
    times its own.  With the sources in order of cap over weight, the first ones
    are at their caps and the rest divide what is left, which is the fixed point
    of resharing the excess.  One row per source, so a window over all is small.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    capped = sums.withColumn("w", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    until = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = capped.withColumns(
        {
            "rest": share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(until), F.lit(0.0)),
            "rest_w": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(until), F.lit(0.0)),
        }
    ).withColumn("level", F.col("rest") / F.col("rest_w"))
    # The first source that its level does not fill sets the level of all that follow.
    open_level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)
    return level.select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(open_level["level"] * F.col("w"), F.col("cap"))).alias("target"),
    )


def _draw(left: int, right: int) -> float:
    """A number in [0, 1) that depends only on the two documents."""
    seed = np.array([left & (2**64 - 1), right & (2**64 - 1)], np.uint64)
    return float(mix(mix(seed[:1]) + seed[1:])[0] >> np.uint64(11)) / 2.0**53


def pivotal(keys: list[int], words: list[int], parts: list[float]) -> tuple[list[float], int | None]:
    """The parts after rounding in order, all 0 or 1 but for at most one, and its place."""
    parts, held = list(parts), None
    for k in range(len(parts)):
        if not 0.0 < parts[k] < 1.0:
            continue
        if held is None:
            held = k
            continue
        i, j = held, k
        # Words that can move from j to i, and from i to j.
        up = min((1.0 - parts[i]) * words[i], parts[j] * words[j])
        down = min(parts[i] * words[i], (1.0 - parts[j]) * words[j])
        if _draw(keys[i], keys[j]) * (up + down) < down:
            move, full_i, done_i = up, 1.0, (1.0 - parts[i]) * words[i] <= parts[j] * words[j]
            full_j = 0.0
        else:
            move, full_i, done_i = -down, 0.0, parts[i] * words[i] <= (1.0 - parts[j]) * words[j]
            full_j = 1.0
        if done_i:
            parts[j] -= move / words[j]
            parts[i] = full_i
            held = j
        else:
            parts[i] += move / words[i]
            parts[j] = full_j
            held = i
        if abs(parts[held] - round(parts[held])) < 1e-12:
            parts[held], held = float(round(parts[held])), None
    return parts, held


def _rounded(level: DataFrame) -> DataFrame:
    """One level of the tree: rows ``sid, chunk, key, uid, size, part`` with ``part`` rounded in each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["sid", "chunk"]):
            columns = [group.column(c).to_pylist() for c in ("key", "size", "part")]
            parts, _ = pivotal(*columns)
            done = group.set_column(group.schema.get_field_index("part"), "part", pa.array(parts, pa.float64()))
            yield from done.combine_chunks().to_batches()

    # Large documents first, so that a small one stays fractional where possible.
    order = ["sid", "chunk", F.desc("size"), "key", "uid"]
    placed = level.select("sid", "chunk", "key", "uid", "size", "part").repartition("sid", "chunk")
    return map_arrow(
        placed.sortWithinPartitions(*order),
        run, "sid long, chunk long, key long, uid long, size long, part double"
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows(uid, key, n, ...)`` with ``chunk``: by the key, and rows of one key in turn where they are many."""
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK), F.lit(1))
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("alike")).filter(F.col("alike") > CHUNK // 4)
    if many.isEmpty():
        return rows.withColumn("chunk", F.pmod("key", chunks))
    alike = rows.join(many.select("key"), "key", "left_semi").select("uid", "key")
    turn = ranked_within(alike, ["key"], ["uid"], "turn").select("uid", "turn")
    placed = rows.join(turn, "uid", "left").withColumn("turn", F.coalesce("turn", F.lit(0)))
    return placed.withColumn("chunk", F.pmod(F.pmod("key", chunks) + F.pmod("turn", chunks), chunks)).drop("turn")


def copies(sized: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sized(uid, doc_id, source, size, ...)`` with ``source_size, target, taken`` and ``n_copies``.

    ``uid`` names the row.  Decisions depend on ``doc_id``, source and size only,
    so a rerun over the same rows agrees.
    """
    targets = source_targets(sized, share, most)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = stored(targets.withColumns({"sid": F.xxhash64("source"), "wanted": wanted}), "targets")
    known = F.col("source").eqNullSafe(F.col("of"))
    joined = sized.join(targets.withColumnRenamed("source", "of"), known).drop("of")
    whole = F.floor("wanted")
    part = F.when(F.col("size") > 0, F.col("wanted") - whole).otherwise(F.lit(0.0))
    key = F.xxhash64("doc_id", "source", "size")
    joined = joined.withColumns({"whole": whole, "part": part, "key": key})
    counts = joined.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg(F.max("n")).first()[0] or 0
    level = _dealt(joined.filter("part > 0").join(counts, "sid"))
    # Rows with equal keys meet in a chunk in any order: they are alike.
    done = []
    while True:
        rounded = stored(_rounded(level), "rounded")
        done.append(rounded.filter("part = 0 or part = 1").select("uid", "part"))
        rest = rounded.filter("part > 0 and part < 1")
        if largest <= CHUNK:
            break
        largest = -(-largest // CHUNK)
        level = rest.withColumn("chunk", F.floor(F.col("chunk") / CHUNK))
    last = (F.col("part") >= 0.5).cast("double")
    done.append(rest.select("uid", last.alias("part")))
    rounds = done[0]
    for more in done[1:]:
        rounds = rounds.unionByName(more)
    n_copies = (F.col("whole") + F.coalesce("rounded", F.lit(0.0))).cast("long")
    return (
        joined.join(rounds.withColumnRenamed("part", "rounded"), "uid", "left")
        .withColumn("n_copies", n_copies)
        .withColumn("taken", F.col("size") * F.col("n_copies"))
        .drop("sid", "wanted", "whole", "part", "key", "rounded")
    )


def sized(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``uid, doc_id, source, size`` and the carried columns of each row, written once so ``uid`` is fixed."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        word_count(F.col("text")).alias("size"),
        *[F.col(f"`{c}`").alias(f"carried_{c}") for c in carry],
    )
    return stored(rows, "sized")


def mix_sources(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs(doc_id, text, source)``.

    A null or blank text has size 0 and is never taken; null is a source of its
    own, after the others.  Null ids are passed through and rows that repeat an
    id are decided one by one.  Other columns are ignored.  With no words at all
    every target is 0; an empty table gives no rows.
    """
    return copies(sized(docs), share, most).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns."""
    rows = sized(docs, tuple(docs.columns))
    chosen = copies(rows.select("uid", "doc_id", "source", "size"), share, most).filter("n_copies > 0")
    kept = rows.join(chosen.select("uid", "n_copies"), "uid")
    repeated = kept.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n_copies")))
    return repeated.select(*[F.col(f"`carried_{c}`").alias(c) for c in docs.columns])


@query()
def op4_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
