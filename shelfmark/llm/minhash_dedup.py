"""Near-duplicate documents: banded MinHash candidates, odd sketches, exact confirmation.

Each document's set of word shingles gives ``SAMPLES`` MinHash values.  The
first ``BANDS * ROWS`` of them name ``BANDS`` buckets; two sets at the threshold
of 0.75 share none with a probability of 1e-6.  All samples are folded into an
odd sketch: sample i toggles one of ``BITS`` parity bits, so the population count
of the XOR of two sketches estimates how many samples differ.  Pairs that meet in
a bucket and whose estimate is within five standard errors of the threshold are
confirmed on the full sets of 64-bit shingle hashes.  Documents that share a
bucket with another component get larger sketches for the second pass, and their
sets go with them: the blocks of a bucket confirm their likely pairs themselves
and hand on only the links that join components, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import components, map_arrow, matrix, sorted_groups, stored, table, text_slices
from shelfmark.llm.registry import query
from shelfmark.llm.words import GOLDEN, mix, shingle_sets

BANDS, ROWS = 36, 4
BLOCK, PIVOTS = 256, 16
# Samples and bits of the sketches of the two passes, and the standard error of an
# estimate at 0.75: that of the samples and that of the folding.
SAMPLES, BITS, ERROR = 256, 512, 0.034
FINE_SAMPLES, FINE_BITS, FINE_ERROR = 2048, 4096, 0.0125

# Sets of more shingles are confirmed by joins, so that no block holds many of them.
LARGE = 1 << 14

_SIGNATURES = "doc_id long, text_hash long, n_shingles long, fp1 long, fp2 long, bands array<long>, sketch binary"


def _constants(samples: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * samples + 1, dtype=np.uint64) * np.uint64(GOLDEN))
    return seeds[:samples] | np.uint64(1), seeds[samples:]


def min_hashes(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest image of the set under each hash function."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 17) // len(factors))
    for at in range(0, len(shingles), step):
        images = shingles[at : at + step, None] * factors[None, :]
        images += shifts
        np.minimum(least, images.min(axis=0), out=least)
    return least


def odd_sketches(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of rows of MinHash samples, as ``bits / 64`` words each."""
    place = mix(samples ^ (np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(GOLDEN))) % np.uint64(bits)
    odd = np.zeros((len(samples), bits), np.uint8)
    for row, own in enumerate(place.astype(np.int64)):
        odd[row] = np.bincount(own, minlength=bits) & 1
    return np.packbits(odd, axis=1, bitorder="little").view(np.uint64)


def estimated_similarity(left: np.ndarray, right: np.ndarray, samples: int) -> np.ndarray:
    """Similarities of all rows of ``left`` with all of ``right``, from their odd sketches."""
    bits = 64 * left.shape[1]
    odd = np.zeros((len(left), len(right)), np.int32)
    for word in range(left.shape[1]):
        odd += np.bitwise_count(left[:, None, word] ^ right[None, :, word])
    share = np.minimum(2.0 * odd / bits, 1 - 1e-9)
    return 1 + bits / (4 * samples) * np.log1p(-share)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles``, a fingerprint of the set, its band keys and its odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _constants(SAMPLES)
        salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        weights = mix(np.arange(101, 101 + ROWS, dtype=np.uint64)) | np.uint64(1)
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text"))
            samples = np.empty((len(sets), SAMPLES), np.uint64)
            prints = np.zeros((len(sets), 2), np.uint64)
            for row, shingles in enumerate(sets):
                samples[row] = min_hashes(shingles, factors, shifts)
                prints[row] = shingles.sum(dtype=np.uint64), mix(shingles ^ np.uint64(GOLDEN)).sum(dtype=np.uint64)
            banded = samples[:, : BANDS * ROWS].reshape(len(sets), BANDS, ROWS)
            keys = mix((banded * weights).sum(axis=2, dtype=np.uint64) + salt)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints[:, 0].view(np.int64)),
                    pa.array(prints[:, 1].copy().view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel().view(np.int64))
                    ),
                    pa.array([row.tobytes() for row in odd_sketches(samples, BITS)], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "fp1", "fp2", "bands", "sketch"],
            )

    return map_arrow(_keyed(docs), run, _SIGNATURES)


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, text``: together these tell texts apart that share an id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def fine_sketches(sets: DataFrame) -> DataFrame:
    """``id, sketch`` of packed shingle sets, with more samples and bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _constants(FINE_SAMPLES)
        for batch in text_slices(batches, "shingles", most=1 << 19):
            packed = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
            samples = np.array([min_hashes(x, factors, shifts) for x in packed])
            sketches = [row.tobytes() for row in odd_sketches(samples, FINE_BITS)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sketches, pa.binary())], names=["id", "sketch"])

    return map_arrow(sets.select("id", "shingles"), run, "id long, sketch binary")


def _candidates(grouped: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of rows that share bucket and block: of each row its likeliest partner.

    Its estimate is within five errors of ``percent``; the smallest of the
    partners an error above ``percent`` is added.
    """
    cut = percent / 100 - 5 * ERROR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Pairs()
        for group in sorted_groups(batches, ["bucket", "block"]):
            if group.num_rows < 2:
                continue
            ids, order = _distinct(group)
            likely = matrix(group.column("sketch"), np.uint64)[order]
            likely = estimated_similarity(likely, likely, SAMPLES)
            np.fill_diagonal(likely, -1)
            sure = np.tril(likely >= percent / 100 + ERROR, -1)
            rows, best = np.flatnonzero(sure.any(axis=1)), np.flatnonzero(likely.max(axis=1) >= cut)
            found.add(
                ids[np.concatenate([rows, best])],
                ids[np.concatenate([sure[rows].argmax(axis=1), likely[best].argmax(axis=1)])],
            )
            yield from found.batches(50_000)
        yield from found.batches(1)

    placed = grouped.repartition("bucket", "block").sortWithinPartitions("bucket", "block")
    return map_arrow(placed, run, "a long, b long").distinct()


class _Pairs:
    """Pairs that are waiting to be handed on, smaller id first."""

    def __init__(self):
        self.lows, self.highs, self.held = [], [], 0

    def add(self, one: np.ndarray, two: np.ndarray) -> None:
        self.lows.append(np.minimum(one, two))
        self.highs.append(np.maximum(one, two))
        self.held += len(one)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.held >= least:
            columns = [pa.array(np.concatenate(x)) for x in (self.lows, self.highs)]
            self.lows, self.highs, self.held = [], [], 0
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _distinct(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a group in order, and where each stands."""
    ids = group.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
    return ids[order], order


def _first_candidates(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each row's best partners in its own block of each bucket.

    A bucket is dealt into blocks of about ``BLOCK`` rows by a hash of the id;
    about ``PIVOTS`` rows, also by hash, join every block and tie blocks together.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    spot = F.pmod(F.xxhash64("id", "bucket"), F.col("n"))
    every = F.when(spot < PIVOTS, F.sequence(F.lit(0).cast("long"), blocks - 1))
    own = F.array(F.pmod(F.xxhash64("bucket", "id"), blocks))
    dealt = buckets.select("bucket", "id", F.explode(F.coalesce(every, own)).alias("block"))
    return _candidates(dealt.join(classes.select("id", "sketch"), "id"), percent)


def _crossing_links(buckets: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Confirmed links ``a < b`` that join what lies in different components so far.

    Rows outside a bucket's largest component are compared with all its rows,
    in blocks, so a bucket that is one component costs nothing.
    """
    of = buckets.join(comps, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", F.coalesce("component_id", "id").alias("comp")
    )
    sizes = of.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = (
        sizes.groupBy("bucket")
        .agg(F.sum("c").alias("n"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
        .filter("most < n")
    )
    rows = stored(of.join(mixed, "bucket"), "mixed")
    mine = sets.join(rows.select("id").distinct(), "id", "left_semi")
    own = F.when(F.length("shingles") <= 8 * LARGE, F.col("shingles")).alias("shingles")
    fine = stored(fine_sketches(mine).join(mine.select("id", own, F.length("shingles").alias("bytes")), "id"), "fine")
    near = F.col("comp") != F.col("main")
    all_blocks, near_blocks = F.ceil(F.col("n") / BLOCK), F.ceil((F.col("n") - F.col("most")) / BLOCK)
    at = F.pmod(F.xxhash64("bucket", "id"), all_blocks)
    near_at = F.pmod(F.xxhash64("id", "bucket"), near_blocks)
    zero = F.lit(0).cast("long")
    as_row = F.transform(F.sequence(zero, near_blocks - 1), lambda k: F.struct((k * all_blocks + at).alias("block"), (near & (near_at == k)).alias("near")))
    as_near = F.when(
        near,
        F.transform(F.sequence(zero, all_blocks - 1), lambda k: F.struct((near_at * all_blocks + k).alias("block"), F.lit(True).alias("near"))),
    ).otherwise(F.array().cast("array<struct<block:bigint,near:boolean>>"))
    dealt = rows.select("bucket", "id", "comp", F.explode(F.concat(as_near, as_row)).alias("at")).select(
        "bucket", "id", "comp", "at.block", "at.near"
    )
    dealt = dealt.groupBy("bucket", "block", "id", "comp").agg(F.max("near").alias("near"))
    found = stored(_block_links(dealt.join(fine, "id"), percent), "crossing")
    large = confirmed(found.filter("not sure").select("a", "b").distinct(), sets, percent)
    return found.filter("sure").select("a", "b").distinct().unionByName(large)


def _block_links(grouped: DataFrame, percent: int) -> DataFrame:
    """``a, b, sure``: links between components that each block confirms, as a forest.

    ``near`` rows are compared with all rows of their group, the likeliest pairs
    first.  A pair of components that are joined already needs no other link, so
    a block gives fewer links than it has rows.  Pairs with a set too large to be
    carried along are handed on unconfirmed.
    """
    cut = percent / 100 - 5 * FINE_ERROR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sure, open_ = _Pairs(), _Pairs()

        def handed(pairs: _Pairs, value: bool, least: int) -> Iterator[pa.RecordBatch]:
            for batch in pairs.batches(least):
                yield batch.append_column("sure", pa.array(np.full(batch.num_rows, value)))

        for group in sorted_groups(batches, ["bucket", "block"]):
            if group.num_rows < 2:
                continue
            ids, order = _distinct(group)
            comps = np.unique(group.column("comp").to_numpy()[order], return_inverse=True)[1]
            sizes = group.column("bytes").to_numpy()[order] // 8
            near = np.flatnonzero(group.column("near").to_numpy(zero_copy_only=False)[order])
            sketches = matrix(group.column("sketch"), np.uint64)[order]
            likely = estimated_similarity(sketches[near], sketches, FINE_SAMPLES)
            smaller = np.minimum(sizes[near][:, None], sizes[None, :])
            larger = np.maximum(sizes[near][:, None], sizes[None, :])
            hit = (likely >= cut) & (100 * smaller >= percent * larger) & (comps[near][:, None] != comps[None, :])
            left, right = np.nonzero(hit)
            best = np.argsort(-likely[left, right], kind="stable")
            column = group.column("shingles")
            carried = column.is_valid().to_numpy()[order]
            links, unsure = _forest(
                near[left[best]], right[best], comps, sizes, carried, lambda k: column[int(order[k])].as_buffer(), percent
            )
            for pairs, kept in ((sure, links), (open_, unsure)):
                if kept:
                    one, two = np.array(kept).T
                    pairs.add(ids[one], ids[two])
            yield from handed(sure, True, 50_000)
            yield from handed(open_, False, 50_000)
        yield from handed(sure, True, 1)
        yield from handed(open_, False, 1)

    placed = grouped.repartition("bucket", "block").sortWithinPartitions("bucket", "block")
    return map_arrow(placed, run, "a long, b long, sure boolean")


def _forest(left, right, comps, sizes, carried, shingles, percent: int) -> tuple[list, list]:
    """Of the pairs in turn, those that are links and join two components; and those whose sets are not both carried."""
    root = list(range(int(comps.max()) + 1))
    links, unsure, sets = [], [], {}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def of(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = np.frombuffer(shingles(k), np.uint64)
        return sets[k]

    for one, two in zip(left.tolist(), right.tolist()):
        a, b = find(comps[one]), find(comps[two])
        if a == b:
            continue
        if not (carried[one] and carried[two]):
            unsure.append((one, two))
            continue
        both = len(np.intersect1d(of(one), of(two), assume_unique=True))
        if 100 * both >= percent * (sizes[one] + sizes[two] - both):
            root[max(a, b)] = min(a, b)
            links.append((one, two))
    return links, unsure


def shingle_table(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``id, shingles`` (packed 64-bit hashes) of the texts in ``chosen(id, doc_id, text_hash)``, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, most=1 << 20):
            packed = [s.tobytes() for s in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "shingles"])

    wanted = _keyed(docs).join(chosen, ["doc_id", "text_hash"]).select("id", "text")
    # Rows with one id are copies of one text.
    return map_arrow(wanted, run, "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with ``100 * intersection >= percent * union`` on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("sa"), batch.column("sb")):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), run, "a long, b long")


def linked_classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signatures of all rows, ``doc_id, text_hash, id`` of those in a class, and the links between classes.

    Equal sets are one class with a number of its own, which stands for one of
    their texts; only classes are compared.  In the first pass each class gives
    its best partners per bucket, which already joins most groups; the second
    pass confirms every likely pair that still lies in two components, so no
    link that decides a component is left out.
    """
    signed = stored(signatures(docs), "signatures")
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    prints = ["fp1", "fp2", "n_shingles"]
    found = named.groupBy(*prints).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("text"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    classes = stored(found.select(F.monotonically_increasing_id().alias("id"), "*"), "classes")
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stored(banded.join(shared, "bucket"), "buckets")
    first = stored(_first_candidates(buckets, classes, percent), "first")
    met = classes.select("id", "text.*").join(buckets.select("id").distinct(), "id", "left_semi")
    sets = stored(shingle_table(docs, met), "sets").dropDuplicates(["id"])
    links = stored(confirmed(first, sets, percent), "confirmed")
    crossing = stored(_crossing_links(buckets, sets, components(links), percent), "links")
    members = named.select("doc_id", "text_hash", *prints).distinct().join(classes.select(*prints, "id"), prints)
    return signed, stored(members.select("doc_id", "text_hash", "id"), "members"), links.unionByName(crossing)


def _named_components(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with ``comp``, the number of the component of their class."""
    comps = components(links)
    joined = members.join(comps, F.col("id") == F.col("node"), "left")
    return joined.select(*members.columns, F.coalesce("component_id", "id").alias("comp"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``.

    Null and blank texts have an empty set and link with nothing.  A null
    ``doc_id`` links with nothing: its ``component_id`` is null and it is kept.
    Rows that share a ``doc_id`` are one node, linked with all that any of their
    texts is linked with.  Other columns are ignored.  An empty table gives no
    rows.
    """
    signed, members, links = linked_classes(docs, percent)
    # Repeated ids tie the classes of their texts together.
    several = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("most")).filter("a < most")
    ties = several.join(members, "doc_id").filter("id > a").select("a", F.col("id").alias("b"))
    placed = stored(_named_components(members, links.unionByName(ties)), "placed")
    smallest = placed.groupBy("comp").agg(F.min("doc_id").alias("least"))
    found = placed.select("doc_id", "comp").distinct().join(smallest, "comp")
    out = signed.join(found.select(F.col("doc_id").alias("node"), "least"), F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("least", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each group of near-duplicates.

    It is the one with the smallest ``doc_id``.  Rows that share an id are told
    apart by their texts, so different texts under one id all stay.  Null and
    blank texts stay, and so do rows without an id.  An empty table gives no rows.
    """
    signed, members, links = linked_classes(docs, percent)
    text = F.struct("doc_id", "text_hash")
    kept = _named_components(members, links).groupBy("comp").agg(F.min(text).alias("text")).select("text.*")
    blank = signed.filter("n_shingles = 0 and doc_id is not null").select("doc_id", "text_hash").distinct()
    chosen = stored(kept.unionByName(blank), "kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    own = [F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash")]
    picked = docs.select("*", *own).join(chosen, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return picked.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


_ORACLE = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s
  from words),
classes as (select min(doc_id) id, list_sort(s) s from sets where len(s) > 0 group by list_sort(s)),
shingles as (select id, len(s) n, unnest(s) x from classes),
links as (
  select l.id a, r.id b from shingles l join shingles r on l.x = r.x and l.id < r.id
  group by l.id, r.id, l.n, r.n having 100 * count(*) >= 75 * (l.n + r.n - count(*))),
edges as (select a, b from links union select b, a from links),
reach(id, r) as (select id, id from classes union select e.b, reach.r from reach join edges e on e.a = reach.id),
comp as (select id, min(r) c from reach group by id)
select s.doc_id, len(s.s)::bigint n_shingles, coalesce(comp.c, s.doc_id) component_id,
  coalesce(comp.c, s.doc_id) = s.doc_id kept
from sets s left join classes k on list_sort(s.s) = k.s left join comp on comp.id = k.id
"""


@query(_ORACLE)
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
