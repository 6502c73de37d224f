"""Ranked lexical search: one Aho-Corasick scan of all texts for the terms of all queries.

The terms of a block of items make an automaton that is broadcast; each is
guarded by a boundary on either side, so only whole terms are found.  A task
walks its texts through it and returns, per document, its number of terms and
how often it holds which query terms.  No index of the documents is made: what
Spark keeps of a document is its hits.  From these it counts documents per term,
and a second pass gives the scores, of which each task hands on the highest few
of each item.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, stored, table, text_slices
from shelfmark.llm.registry import query

# Bytes of terms in a block of items, with as many again for one item: what an automaton is made of.
BLOCK_BYTES = 1 << 20
TOP = 10
# Entries of the table of documents and items that a task adds up at a time.
_CELLS = 1 << 21
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GUARD = " "


def guarded(texts: pa.Array) -> pa.Array:
    """The terms of each text in lower case (A-Z only), with a guard before, between and after them."""
    # Lower-cased before the cast: Arrow's ascii_lower misreads what a cast makes of a slice.
    texts = pc.fill_null(pc.ascii_lower(texts).cast(pa.large_string()), "")
    inner = pc.ascii_trim(pc.replace_substring_regex(texts, _GAPS, _GUARD), _GUARD)
    edge = pa.scalar("", pa.large_string())
    return pc.binary_join_element_wise(edge, inner, edge, pa.scalar(_GUARD, pa.large_string()))


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms``: the distinct terms of each item, sorted; rows with one id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            lists = pc.split_pattern(pc.ascii_trim(guarded(batch.column("text")), _GUARD), _GUARD)
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists.cast(pa.list_(pa.string()))], names=["item_id", "terms"])

    each = map_arrow(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, "item_id long, terms array<string>")
    terms = each.select("item_id", F.explode("terms").alias("term")).filter("term <> ''")
    return terms.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


class _Block:
    """A block of items: its terms, sorted, and which items want which."""

    def __init__(self, rows: list):
        self.items = np.array([-1 if r.item_id is None else r.item_id for r in rows], np.int64)
        self.null_item = np.array([r.item_id is None for r in rows])
        self.terms = sorted({t for r in rows for t in r.terms})
        number = {t: k for k, t in enumerate(self.terms)}
        pairs = sorted((number[t], at) for at, r in enumerate(rows) for t in r.terms)
        # The items of term k are wanted[bounds[k]:bounds[k + 1]].
        self.wanted = np.array([at for _, at in pairs], np.int64)
        self.bounds = np.searchsorted(np.array([k for k, _ in pairs], np.int64), np.arange(len(self.terms) + 1))


_AUTOMATON: dict = {}


def _automaton(key, terms: list[str]):
    """The automaton of this worker's current block; it outlives a task."""
    if key not in _AUTOMATON:
        import ahocorasick

        made = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            made.add_word(f"{_GUARD}{term}{_GUARD}", number)
        made.make_automaton()
        _AUTOMATON.clear()
        _AUTOMATON[key] = made
    return _AUTOMATON[key]


def hits(docs: DataFrame, terms) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row: its terms with repeats, and which of the broadcast ones it holds how often."""
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, terms.value)
        for batch in text_slices(batches):
            texts = guarded(batch.column("text"))
            n = pc.subtract(pc.count_substring(texts, _GUARD), 1)
            n = pc.if_else(pc.equal(texts, _GUARD * 2), 0, n)
            found, counts, bounds = [], [], [0]
            for text in texts:
                numbers = [k for _, k in automaton.iter(text.as_py())] if terms.value else []
                own, often = np.unique(np.array(numbers, np.int32), return_counts=True)
                found.append(own)
                counts.append(often)
                bounds.append(bounds[-1] + len(own))
            offsets = pa.array(bounds, pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind)))
                for x, kind in ((found, np.int32), (counts, np.int64))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n.cast(pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(picked, run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` rows of each item: highest score, then smallest document, nulls last."""
    order = np.lexsort((doc, null, -score, item))
    sorted_items = item[order]
    start = np.searchsorted(sorted_items, sorted_items)
    return order[np.arange(len(order)) - start < top]


def scores(found: DataFrame, block, weights, documents: int, total: int, top: int = TOP) -> DataFrame:
    """``item, doc_id, score`` of the best documents of each item in each task, from ``hits``.

    ``block`` and ``weights`` are broadcast: the items and the weights of their terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = block.value, weights.value
        count = len(own.items)
        sizes = np.diff(own.bounds)
        held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        least = np.ones(count, np.int64)
        for batch in batches:
            lists = batch.column("terms")
            at = lists.offsets.to_numpy().astype(np.int64)
            terms = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
            tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy()
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            at = at - at[0]
            m = 10 + (90 * n * documents) // max(total, 1)
            rows = np.repeat(np.arange(len(n)), np.diff(at))
            values = weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[rows]))
            # Chunks of documents that fit the table and whose terms have not too many items.
            pairs = np.concatenate([[0], np.cumsum(sizes[terms])])[at]
            start = 0
            while start < len(n):
                end = int(np.searchsorted(pairs, pairs[start] + _CELLS, "right")) - 1
                end = max(start + 1, min(end, start + max(1, _CELLS // max(count, 1)), len(n)))
                part = slice(at[start], at[end])
                t = terms[part]
                width = sizes[t]
                ends = np.cumsum(width)
                place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - width, width)
                item = own.wanted[np.repeat(own.bounds[t], width) + place]
                sums = np.zeros((end - start) * count, np.int64)
                np.add.at(sums, np.repeat(rows[part] - start, width) * count + item, np.repeat(values[part], width))
                sums = sums.reshape(-1, count)
                doc, item = np.nonzero(sums >= least[None, :])
                new = [item, sums[doc, item], ids[start + doc], null[start + doc]]
                held = [np.concatenate(x) for x in zip(held, new)]
                keep = _best(held[0], held[1], held[2], held[3], top)
                held = [x[keep] for x in held]
                full = np.bincount(held[0], minlength=count) >= top
                lowest = np.full(count, np.iinfo(np.int64).max)
                np.minimum.at(lowest, held[0], held[1])
                least = np.where(full, lowest, 1)
                start = end
        item, score, doc, null = held
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own.items[item], mask=own.null_item[item]),
                    pa.array(doc, mask=null),
                    pa.array(score),
                ],
                names=["item_id", "doc_id", "score"],
            )

    return map_arrow(found, run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of ``docs(doc_id, text)`` for each of ``items(item_id, text)``.

    Items are dealt into blocks by the bytes of their terms; each block is one
    scan, so what is broadcast does not grow with the items.  A null text holds
    no terms.  Rows that share a ``doc_id`` are documents of their own, and a
    null id comes last among equal scores; rows that share an ``item_id`` are one
    item, and null is an item too.  Items without terms, or without a document
    that holds one, give no rows, and so do empty tables.  Other columns are
    ignored.
    """
    spark = docs.sparkSession
    wanted = stored(item_terms(items), "items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 2)
    blocks = -(-(wanted.agg(F.sum(size)).first()[0] or 0) // block_bytes)
    best = None
    for number in range(blocks):
        mine = wanted.filter(F.pmod(F.xxhash64(F.lit("block"), "item_id"), F.lit(blocks)) == number)
        block = _Block(mine.orderBy("item_id").collect())
        if not len(block.items):
            continue
        found = stored(hits(docs, spark.sparkContext.broadcast(block.terms)), "hits")
        total, documents = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
        held = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = np.zeros(len(block.terms), np.int64)
        for row in held.collect():  # at most the terms of the block
            df[row.term] = row.df
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        sent = [spark.sparkContext.broadcast(x) for x in (block, weights)]
        own = scores(found.filter("size(terms) > 0"), *sent, documents, total, top)
        best = own if best is None else best.unionByName(own)
    if best is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


_ORACLE = rf"""
with words as (
  select row_number() over () rid, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{_TERM}'),
    lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) w from documents),
sized as (select rid, doc_id, len(w)::bigint n, w from words where len(w) > 0),
totals as (select count(*)::bigint docs, sum(n)::bigint l from sized),
tf as (select rid, term, count(*)::bigint tf from (select rid, unnest(w) term from sized) group by rid, term),
items as (select distinct item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '{_TERM}'),
  lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) term from benchmark),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint w
  from tf, totals where term in (select term from items) group by term, docs),
scored as (
  select i.item_id, s.rid, s.doc_id,
    sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + (90 * s.n * t.docs) // t.l))))::bigint score
  from items i join weights w using (term) join tf using (term) join sized s on s.rid = tf.rid, totals t
  group by i.item_id, s.rid, s.doc_id),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) rank from scored where score > 0)
select item_id, rank::integer rank, doc_id, score from ranked where rank <= {TOP}
"""


@query(_ORACLE)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
