"""Near-duplicate vectors: random-hyperplane tables, exact cosines, distributed components.

Each table hashes a vector to the signs of its projections on ``bits`` random
normals.  Two vectors at cosine 0.98 agree on one sign with a probability of
1 - acos(0.98) / pi, so with ``bits`` about log2 of the number of vectors the
number of tables follows from the wanted miss rate; both grow slowly with the
table, by one formula at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import components, ddl, local_roots, map_arrow, matrix, sorted_groups, stored, table
from shelfmark.llm.registry import query

BLOCK = 256
MISS = 1e-6
# So many rows of buckets at least are worked on at once, about two pairs of blocks.
TOGETHER = 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table_shape(vectors: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits to a table and number of tables for so many vectors."""
    bits = max(8, math.ceil(math.log2(max(2, vectors))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def sign_hashes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A 64-bit hash of each vector's signs in each table; the normals come from a fixed seed."""
    normals = np.random.default_rng(20).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ normals >= 0).reshape(len(vectors), tables, bits)
    keys = np.zeros((len(vectors), tables), np.uint64)
    for bit in range(bits):
        keys = keys * np.uint64(2) + signs[:, :, bit]
    return (keys * _ODD) ^ (keys >> np.uint64(32))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v`` of the rows that can link: finite, not zero, with a label."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = finite & F.exists(v, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v")).filter(ok)


def _hashed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    schema = ddl(classes) + ", hashes array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                keys = sign_hashes(matrix(part.column("v"), np.float64), bits, tables)
                bounds = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables)
                column = pa.ListArray.from_arrays(bounds, pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, "hashes"])

    return map_arrow(classes, run, schema)


def _near_pairs(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The places of the pairs at the threshold or nearer, of whole blocks or pairs of blocks of vectors of one length."""
    t, bucket, own, low, high = (rows.column(c).to_numpy() for c in ("t", "bucket", "own", "low", "high"))
    new = np.ones(len(own), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in (t, bucket, low, high)], axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(starts, append=len(own))
    vectors = matrix(rows.column("v"), np.float64)
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    one_block = low[starts] == high[starts]
    none = np.zeros(0, np.int64)
    left, right = [none], [none]
    # Blocks of as many vectors make one product of stacked matrices.
    for size in np.unique(sizes[one_block & (sizes > 1)]):
        first = starts[one_block & (sizes == size)]
        stacked = unit[first[:, None] + np.arange(size)]
        k, i, j = np.nonzero(np.triu(stacked @ stacked.transpose(0, 2, 1) >= threshold, 1))
        left.append(first[k] + i)
        right.append(first[k] + j)
    for start, size in zip(starts[~one_block], sizes[~one_block]):
        at = np.arange(start, start + size)
        a, b = at[own[at] == low[start]], at[own[at] == high[start]]
        i, j = np.nonzero(unit[a] @ unit[b].T >= threshold)
        left.append(a[i])
        right.append(b[j])
    return np.concatenate(left), np.concatenate(right)


def _linked(dealt: DataFrame, threshold: float) -> DataFrame:
    """``cid, links, id, root``: per block the links of each vector first met there, and whom it reaches."""
    keys = ["t", "bucket", "dims", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most buckets hold a few vectors, so many are worked on together.
        for groups in sorted_groups(batches, keys, TOGETHER):
            dims = groups.column("dims").to_numpy()
            for size in np.unique(dims):
                rows = groups.filter(pa.array(dims == size))
                i, j = _near_pairs(rows, threshold)
                same = rows.column("label").to_numpy()
                ok = same[i] == same[j]
                i, j = i[ok], j[ok]
                # A pair counts only in the first table in which it meets.
                hashes, t = matrix(rows.column("hashes"), np.int64), rows.column("t").to_numpy()[i]
                new = np.ones(len(i), bool)
                for earlier in range(hashes.shape[1]):
                    new &= (hashes[i, earlier] != hashes[j, earlier]) | (earlier >= t)
                i, j = i[new], j[new]
                if not len(i):
                    continue
                copies, ids = rows.column("copies").to_numpy(), rows.column("id").to_numpy()
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                by_id = np.argsort(ids)
                rank = np.argsort(by_id)
                root = local_roots(len(ids), rank[i], rank[j])
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("cid").combine_chunks().take(pa.array(hit)),
                        pa.array(links[hit].astype(np.int64)),
                        pa.array(ids[hit]),
                        pa.array(ids[by_id][root[rank[hit]]]),
                    ],
                    names=["cid", "links", "id", "root"],
                )

    return map_arrow(dealt.repartition(*keys).sortWithinPartitions(*keys), run, "cid long, links long, id long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding, label)``.

    Two vectors link when their labels are equal and their cosine, in doubles,
    is at least ``threshold``.  Equal vectors of a label are compared once and
    counted with their copies.  A hot bucket is dealt into blocks of about
    ``BLOCK`` vectors and every pair of blocks is one small matrix product that
    gives counts and one link per vector, never pairs.

    Vectors that are null, empty, zero or hold null or non-finite components,
    null labels and null ids link with nothing; a null ``vec_id`` has a null
    ``component_id`` and is kept.  Vectors of different lengths never link.
    Rows that repeat a ``vec_id`` are vectors of their own that share a
    component; each shows the links of the row of that id that has most.  Other columns are
    ignored.  An empty table gives no rows.
    """
    usable = usable_vectors(vectors)
    classes = stored(
        usable.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    bits, tables = table_shape(classes.count(), threshold)
    # Ids may repeat over classes, so each class gets a number of its own, fixed once written.
    hashed = _hashed(classes, bits, tables).withColumns({"dims": F.size("v"), "cid": F.monotonically_increasing_id()})
    numbered = stored(hashed, "hashed")
    keyed = numbered.select("cid", "label", "dims", F.posexplode("hashes").alias("t", "bucket"))
    shared = keyed.groupBy("label", "dims", "t", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = keyed.join(shared, ["label", "dims", "t", "bucket"])
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("cid", "bucket"), blocks)
    spread = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    # Labels share no bucket: the label is part of its key, as is the vectors' length.
    dealt = spread.select(
        "cid",
        "t",
        F.xxhash64("bucket", "label").alias("bucket"),
        "own",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
    ).join(numbered, "cid")
    found = stored(_linked(dealt, threshold), "found")
    counts = found.groupBy("cid").agg(F.sum("links").alias("outer"))
    # A vector that is there once is its class, and only copies are looked up by vector. Their classes
    # are stored first, so Spark knows how little they are before it joins.
    few = ["id", "cid", "copies"]
    twins = stored(numbered.filter("copies > 1").select("label", "v", *few), "twins")
    copied = stored(usable.join(twins, ["label", "v"]).select("vec_id", *few), "copied")
    member = numbered.filter("copies = 1").select(F.col("id").alias("vec_id"), *few).unionByName(copied)
    links = member.join(counts, "cid", "left").groupBy("vec_id").agg(
        F.max(F.col("copies") - 1 + F.coalesce("outer", F.lit(0))).alias("n_links")
    )
    ties = copied.filter("vec_id <> id").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
    comps = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(ties))
    component = F.coalesce("component_id", "vec_id")
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
        .join(links, "vec_id", "left")
        .join(comps, F.col("vec_id") == F.col("node"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )


_ORACLE = """
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) v from embeddings
  where label is not null and vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select l.vec_id a, r.vec_id b from usable l join usable r
  on l.label = r.label and l.vec_id <> r.vec_id and len(l.v) = len(r.v)
  where list_cosine_similarity(l.v, r.v) >= 0.98),
reach(id, r) as (select vec_id, vec_id from usable union select l.b, reach.r from reach join links l on l.a = reach.id),
comp as (select id, min(r) c from reach group by id),
counts as (select a, count(*) n from links group by a)
select e.vec_id, coalesce(n, 0) n_links, coalesce(c, e.vec_id) component_id, coalesce(c, e.vec_id) = e.vec_id kept
from embeddings e left join counts on a = e.vec_id left join comp on id = e.vec_id
"""


@query(_ORACLE)
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
