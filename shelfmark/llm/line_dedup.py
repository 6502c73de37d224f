"""Lines that several documents share stay in one of them; the result is a bitmap, not text.

Hashes of the lines are range-partitioned and sorted by document and position
within each hash, so a task streams a line's occurrences and knows the first one
without holding them.  A line in a large share of all documents is dealt over the
tasks by a slice of its documents: the first pass leaves one document a slice, the
second pass, over the hash alone, leaves one.  With the root of the number of
lines as the number of slices, no run of either pass is longer than that root.
What goes is returned as runs of positions, and the bitmap of what stays as the
runs between them.  Everything is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, table
from shelfmark.llm.registry import query

LEAST_CHARS = 10
_SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUNS = "array<struct<start:int,length:int>>"
_KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The lines of a whole text; a null or empty one is an empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, ASCII letters in lower case."""
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.btrim(F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER)), F.lit(_SPACES))


def line_hashes(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``h1, h2, doc_id, text_hash, position`` of every line that takes part."""
    lines = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(lines_of(F.col("text"))).alias("position", "line"),
    )
    key = F.col("key")
    keyed = lines.select("doc_id", "text_hash", "position", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length(key) >= least).select(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "doc_id", "text_hash", "position"
    )


def _streamed(rows: DataFrame, *run: str) -> DataFrame:
    """Add ``first``, the smallest document of each run, to rows range-partitioned by it."""
    first = F.first("doc_id").over(Window.partitionBy(*run).orderBy("doc_id", "position"))
    return rows.repartitionByRange(*run).withColumn("first", first)


def repeated_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, text_hash, position`` of the lines that a smaller ``doc_id`` also holds."""
    rows = stored(line_hashes(docs, least), "lines")
    slices = max(1, math.isqrt(rows.count()))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
    once = stored(_streamed(sliced, *_KEY, "slice").withColumn("again", F.col("doc_id") > F.col("first")), "sliced")
    place = ["doc_id", "text_hash", "position"]
    twice = _streamed(once.filter(~F.col("again")).select(*_KEY, *place), *_KEY)
    return once.filter("again").select(*place).unionByName(twice.filter("doc_id > first").select(*place))


def dropped_runs(positions: DataFrame) -> DataFrame:
    """``doc_id, text_hash, dropped``: the positions of each text as sorted runs."""
    text = ["doc_id", "text_hash"]
    place = F.row_number().over(Window.partitionBy(*text).orderBy("position"))
    islands = positions.distinct().withColumn("island", F.col("position") - place)
    runs = islands.groupBy(*text, "island").agg(
        F.min("position").alias("start"), F.count(F.lit(1)).cast("int").alias("length")
    )
    return runs.groupBy(*text).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("dropped"))


def kept_runs(dropped: Column, n_lines: Column) -> Column:
    """The runs of ``n_lines`` positions between dropped ones."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda r: r["start"] + r["length"]))
    ends = F.concat(F.transform(dropped, lambda r: r["start"]), F.array(n_lines))
    between = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return F.filter(between, lambda r: r["length"] > 0)


def keep_bitmaps(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """The rows of ``docs`` with ``n_lines`` and ``keep``, the run-length bitmap of the lines that stay.

    A line takes part if its key has ``least`` code points; where two documents
    hold it, all of its lines go but those of the smallest ``doc_id``.  A null or
    empty text is one empty line.  Rows that share a ``doc_id`` are one document,
    each with a bitmap of its own text.  A null ``doc_id`` neither loses lines
    nor takes them from others.  The columns of ``docs`` come back as ``in_*``;
    an empty table gives no rows.
    """
    runs = dropped_runs(repeated_lines(docs, least))
    own = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns])
    own = own.withColumns({"own_id": F.col("in_doc_id").cast("long"), "own_hash": F.xxhash64("in_text")})
    joined = own.join(runs, (F.col("own_id") == F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    n_lines = F.size(lines_of(F.col("in_text")))
    out = joined.select(*[f"in_{c}" for c in docs.columns], n_lines.alias("n_lines"), "dropped")
    dropped = F.coalesce("dropped", F.array().cast(_RUNS))
    return out.withColumn("keep", kept_runs(dropped, F.col("n_lines"))).drop("dropped")


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps, put together again."""
    lines = lines_of(text)
    return F.array_join(F.transform(keep, lambda r: F.array_join(F.slice(lines, r["start"] + 1, r["length"]), "\n")), "\n")


_ORACLE = rf"""
with docs as (select row_number() over () rid, doc_id, string_split(coalesce(text, ''), chr(10)) l from documents),
lines as (select rid, doc_id, unnest(l) line, generate_subscripts(l, 1) place from docs),
keyed as (select *, trim(translate(line, '{_UPPER}', '{_LOWER}'),
  ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) k from lines),
shared as (select k, min(doc_id) first from keyed where length(k) >= {LEAST_CHARS} group by k having count(distinct doc_id) > 1),
marked as (select rid, doc_id, line, place, coalesce(doc_id > first, false) gone from keyed left join shared using (k))
select any_value(doc_id) doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) kept_sha256
from marked group by rid
"""


@query(_ORACLE)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = keep_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.aggregate("keep", F.lit(0), lambda n, r: n + r["length"])
    return out.select(
        F.col("in_doc_id").cast("long").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - kept).cast("long").alias("n_dropped"),
        F.sha2(kept_text(F.col("in_text"), F.col("keep")), 256).alias("kept_sha256"),
    )
