"""Perplexities of texts under word four-grams with modified Kneser-Ney smoothing, with little on disk.

The corpus is stored once as slices of numbered words.  Its positions (a word and
the three before it) are then worked on in passes: each pass deals a share of them
into buckets by the word before the last, so that a bucket has all four-grams,
trigrams and bigrams around that word, with their contexts.  Words before more than
``hot_words`` positions are dealt by the word before them too.  A bucket lacks only
what spans buckets: how many words each word follows, and for hot words the bigrams.
The first round of passes adds these up by ranges of the last word's hash, and the
counts of counts that the discounts come from; sums go back to the buckets that asked,
in the order in which they asked.  The second round deals the positions anew and
scores them.  Between passes the shuffle files are released, so the disk holds the
slices, what was asked, and one pass.  Nothing is sampled or cut off.

What is dealt names the commonest words by their rank and only the others by their
hash: pieces of a slice get smaller as buckets get more, and a list of all hashes in
each would outgrow their positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import _stored_at, removed, shuffles_released, text_slices
from shelfmark.llm.words import GOLDEN, mix
from shelfmark.session import scratch_path

HALVES = (0, 1)
# Words that a slice has less often do not count as common there.
LEAST_NAMED = 4


class Sizes(NamedTuple):
    """How the work is cut; no result depends on it."""

    slice_words: int = 4_000_000
    pass_words: int = 1_000_000  # a pass more for so many words, up to ``passes``
    passes: int = 8
    answer_turns: int = 4
    bucket_words: int = 800_000
    hot_words: int = 1_000_000
    range_words: int = 32_000_000
    common_words: int = 100_000


def _held(width: int) -> int:
    """Bytes of the smallest integer that has so many."""
    return 1 << (width - 1).bit_length()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers from 0 in as few bytes as the largest needs, compressed byte by byte of the numbers."""
    head, body = [], []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        width = max(1, -(-top.bit_length() // 8))
        planes = a.astype(f"<u{_held(width)}", copy=False).view(np.uint8).reshape(-1, _held(width))
        parts = [pa.compress(planes[:, k].tobytes(), codec="zstd", asbytes=True) for k in range(width)]
        head += [len(a), width, *map(len, parts)]
        body += parts
    return np.array([len(head), *head], "<u4").tobytes() + b"".join(body)


def unpack(data: bytes) -> list[np.ndarray]:
    view = memoryview(data)
    head = np.frombuffer(view[4 : 4 + 4 * int(np.frombuffer(view[:4], "<u4")[0])], "<u4").tolist()
    at, k, arrays = 4 + 4 * len(head), 0, []
    while k < len(head):
        length, width = head[k : k + 2]
        planes = np.zeros((length, _held(width)), np.uint8)
        for j, size in enumerate(head[k + 2 : k + 2 + width]):
            planes[:, j] = np.frombuffer(pa.decompress(view[at : at + size], length, codec="zstd"), np.uint8)
            at += size
        arrays.append(planes.reshape(-1).view(f"<u{_held(width)}"))
        k += 2 + width
    return arrays


def ranked(a: np.ndarray, b: np.ndarray, bounds: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row, by its pair in ascending order, and a row of each pair."""
    bits = max(len(a) - 1, 1).bit_length()
    if max(bounds[0], 1) * max(bounds[1], 1) << bits < 1 << 63:
        # The row's place in the low bits: sorting numbers is much cheaper than finding their order.
        # In place: fresh arrays cost as much as the sums.
        key = a.astype(np.int64)
        key *= bounds[1]
        key += b
        key <<= bits
        key |= np.arange(len(a))
        key.sort()
        order = key & ((1 << bits) - 1)
        key >>= bits
        new = np.ones(len(key), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        del key
    else:
        order = np.lexsort((b, a))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    number = np.cumsum(new)
    number -= 1
    codes = np.empty(len(order), np.int64)
    codes[order] = number
    return codes, order[new]


def discounts(*often: int) -> np.ndarray:
    """Discounts of counts 1, 2 and more, where so many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (max(1, n) for n in often)
    y = n1 / (n1 + 2 * n2)
    d = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0.1, 0.2, 0.3], [0.95, 1.9, 2.85])


def _often(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _cut(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], d]).take(np.minimum(counts, 3))


def slices_of(docs: DataFrame, coded: Callable, sizes: Sizes) -> DataFrame:
    """``slice, words, keys, body`` of ``docs(t, text)``: the texts that have words, as numbers.

    ``coded(texts)`` gives bounds, a number for each word, and of each number the
    word's 64-bit hash and whether it is a word to take the mean over.  The numbers
    of a slice go by frequency; three zeros stand before each text.
    """

    def sliced(held: list, number: int) -> tuple:
        hashes, own = np.unique(np.concatenate([h for _, h, _, _ in held]), return_inverse=True)
        starts = np.cumsum([0, *[len(h) for _, h, _, _ in held]])
        counted = np.zeros((2, len(hashes)), np.int64)
        for (seq, _, flags, _), start, end in zip(held, starts, starts[1:]):
            counted[0] += np.bincount(own[start:end], np.bincount(seq, minlength=end - start + 1)[1:], len(hashes)).astype(np.int64)
            counted[1, own[start:end]] = flags
        by_count = np.argsort(-counted[0], kind="stable")
        place = np.empty(len(hashes), np.uint32)
        place[by_count] = np.arange(1, len(hashes) + 1)
        seqs = [np.concatenate([np.zeros(1, np.uint32), place[own[start:end]]])[seq] for (seq, *_), start, end in zip(held, starts, starts[1:])]
        keys = np.concatenate([k for *_, k in held]).view(np.uint64)
        body = pack(hashes[by_count], counted[1][by_count], np.concatenate(seqs))
        return (TaskContext.get().partitionId() << 32) | number, int(counted[0].sum()), pack(keys), body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, number = [], 0, 0
        row = lambda x: pa.RecordBatch.from_arrays([pa.array([v]) for v in x], names=["slice", "words", "keys", "body"])
        for batch in text_slices(batches):
            bounds, codes, hashes, flags = coded(batch.column("text"))
            if not len(codes):
                continue
            lengths = np.diff(bounds)
            full = lengths > 0
            seq = np.zeros(len(codes) + 3 * int(full.sum()), np.uint32)
            seq[np.arange(len(codes)) + 3 * np.repeat(np.cumsum(full), lengths)] = codes + 1
            held.append((seq, hashes, flags, batch.column("t").to_numpy()[full]))
            words += len(codes)
            if words >= sizes.slice_words:
                yield row(sliced(held, number))
                held, words, number = [], 0, number + 1
        if held:
            yield row(sliced(held, number))

    return docs.select("t", "text").mapInArrow(run, "slice long, words long, keys binary, body binary")


def hot_words(slices: DataFrame, total: int, limit: int) -> np.ndarray:
    """The hashes of all words that stand at more than ``limit`` places, at most ``2 * total / limit`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, words in zip(batch.column("body"), batch.column("words").to_pylist()):
                hashes, _, seq = unpack(body.as_buffer())
                often = np.bincount(seq, minlength=len(hashes) + 1)[1:]
                many = often * total >= limit * words / 2
                yield pa.RecordBatch.from_arrays([pa.array(hashes[many].view(np.int64)), pa.array(often[many])], names=["word", "often"])

    found = slices.select("words", "body").mapInArrow(run, "word long, often long")
    rows = found.groupBy("word").agg(F.sum("often").alias("often")).filter(F.col("often") > limit / 2).collect()
    return np.sort(np.array([r.word for r in rows], np.int64).view(np.uint64))


class Common(NamedTuple):
    """Hashes by rank of words that are named by it, from 1, and whether each is one to take the mean over; 0 stands before texts."""

    hashes: np.ndarray
    flags: np.ndarray


def common_words(slices: DataFrame, most: int) -> Common:
    """About the commonest ``most`` words, by counts in the slices that have them ``LEAST_NAMED`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                hashes, flags, seq = unpack(body.as_buffer())
                often = np.bincount(seq, minlength=len(hashes) + 1)[1 : most + 1]
                often = often[often >= LEAST_NAMED]
                columns = [hashes[: len(often)].view(np.int64), often, flags[: len(often)] > 0]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "often", "flag"])

    found = slices.select("body").mapInArrow(run, "word long, often long, flag boolean")
    summed = found.groupBy("word").agg(F.sum("often").alias("often"), F.max("flag").alias("flag"))
    rows = summed.orderBy(F.desc("often"), "word").limit(most).toArrow()
    words, flags = (rows.column(c).to_numpy() for c in ("word", "flag"))
    return Common(np.concatenate([[0], words]).astype(np.int64).view(np.uint64), np.concatenate([[False], flags]).astype(bool))


def dealt(slices: DataFrame, turn: int, passes: int, buckets: int, hot: np.ndarray, common: Broadcast[Common]) -> DataFrame:
    """``bucket, source, body``: the positions of this pass, by slice and bucket.

    A piece's body: hashes and flags of its words that have no rank,
    which are numbered after those that have, the four words of each position, the
    difference of its text's place in the slice, and the half of each text it meets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = common.value.hashes
        first, ranks = len(by_rank), np.argsort(by_rank)
        ascending = by_rank[ranks]
        for batch in batches:
            for number, keys, body in zip(batch.column("slice").to_pylist(), batch.column("keys"), batch.column("body")):
                hashes, flags, seq = unpack(body.as_buffer())
                halves = (unpack(keys.as_buffer())[0] & 1).astype(np.uint8)
                hashes, flags = np.concatenate([np.zeros(1, np.uint64), hashes]), np.concatenate([[0], flags])
                mixed = mix(hashes * np.uint64(GOLDEN))
                bucket_of = (mixed % np.uint64(buckets)).astype(np.int64)
                # Hot words go on by the word before them; ``buckets`` is a multiple of ``passes``.
                is_hot = np.isin(hashes, hot)
                further = (mix(mixed) % np.uint64(buckets)).astype(np.int64)
                own_pass, every, none = (further % passes).astype(np.uint16), passes, passes + 1
                wanted = np.where(is_hot, (turn - bucket_of) % passes, np.where(bucket_of % passes == turn, every, none)).astype(np.uint16)
                # Where the position is of this pass, in stretches that stay in the processor's cache.
                found = []
                for at in range(0, len(seq) - 3, 1 << 16):
                    end = min(at + (1 << 16), len(seq) - 3)
                    near = seq[at + 1 : end + 3].astype(np.intp)
                    want = wanted.take(near[1:-1])
                    mine = (want == every) | (want == own_pass.take(near[:-2]))
                    found.append(at + np.flatnonzero(mine & (near[2:] != 0)))
                chosen = np.concatenate(found)
                before = seq.take(chosen + 2)
                bucket = bucket_of.take(before)
                at = np.flatnonzero(is_hot.take(before))
                bucket[at] = (bucket[at] + further.take(seq.take(chosen[at] + 1))) % buckets
                if not len(chosen):
                    continue
                texts = np.searchsorted(chosen, np.flatnonzero(seq == 0)[::3])
                doc = np.repeat(np.arange(len(texts)), np.diff(texts, append=len(chosen)))
                order = np.argsort((bucket // passes).astype(np.uint16 if buckets < 1 << 16 else np.int64), kind="stable")
                bucket, doc = bucket.take(order), doc.take(order)
                at = np.minimum(np.searchsorted(ascending, hashes), first - 1)
                code = np.where(ascending[at] == hashes, ranks[at], first + np.arange(len(hashes))).astype(np.uint32)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                bounds = np.concatenate([[0], cuts, [len(bucket)]])
                piece = np.repeat(np.arange(len(cuts) + 1), np.diff(bounds))
                words = np.concatenate([code.take(seq.take(chosen + k)).take(order) for k in range(4)])
                # The words without a rank, piece by piece.
                rare = np.flatnonzero(words >= first)
                rare_piece, rare_word = piece[rare % len(piece)], words[rare] - first
                place, at = ranked(rare_piece, rare_word, (len(bounds), len(hashes)))
                own, starts = rare_word[at], np.searchsorted(rare_piece[at], np.arange(len(bounds)))
                words[rare] = first + place - starts[rare_piece]
                words = words.reshape(4, -1)
                for k, (start, end) in enumerate(zip(bounds, bounds[1:])):
                    mine, step = own[starts[k] : starts[k + 1]], np.diff(doc[start:end], prepend=0)
                    met = doc[start:end][np.concatenate([[True], step[1:] > 0])]
                    packed = pack(hashes[mine].view(np.uint8), flags[mine], *words[:, start:end], step, halves[met])
                    columns = [[int(bucket[start])], [number], [packed]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))], names=["bucket", "source", "body"])

    return slices.select("slice", "keys", "body").mapInArrow(run, "bucket int, source long, body binary")


class Bucket:
    """The n-grams around the words of one bucket, their counts by half and their contexts."""

    def __init__(self, rows: list[tuple[int, bytes]], hot: np.ndarray, common: Common, ranges: int):
        parts = [unpack(body) for _, body in sorted(rows, key=lambda r: r[0])]
        first = len(common.hashes)
        rare, own = np.unique(np.concatenate([p[0] for p in parts]).view(np.uint64), return_inverse=True)
        flags = np.zeros(len(rare), bool)
        flags[own] = np.concatenate([p[1] for p in parts]) > 0
        self.hashes, self.flags = np.concatenate([common.hashes, rare]), np.concatenate([common.flags, flags])
        self.sources = [s for s, _ in sorted(rows, key=lambda r: r[0])]
        self.sizes = [len(p[2]) for p in parts]
        starts, ends = np.cumsum([0, *[len(p[1]) for p in parts]]), np.cumsum(self.sizes)

        def numbers(k: int) -> np.ndarray:
            codes = np.concatenate([p[2 + k] for p in parts]).astype(np.int64)
            at = np.flatnonzero(codes >= first)
            codes[at] = first + own[codes[at] - first + starts[np.searchsorted(ends, at, side="right")]]
            return codes

        c0, c1, c2, c3 = (numbers(k) for k in range(4))
        # The texts that each piece meets, and of each position which one it is.
        self.met = [np.cumsum(s, dtype=np.int64)[np.concatenate([[True], s[1:] > 0])] for s in (p[6] for p in parts)]
        self.docs = [np.cumsum(np.concatenate([[0], p[6][1:] > 0]), dtype=np.int32) for p in parts]
        self.half = np.concatenate([p[7][docs] for p, docs in zip(parts, self.docs)])
        words, rows_ = len(self.hashes), len(c3)
        del parts
        pair, _ = ranked(c2, c1, (words, words))
        del c1
        context, _ = ranked(pair, c0, (rows_, words))
        del c0
        self.four, at4 = ranked(context, c3, (rows_, words))
        # Of each four-gram its trigram, of each trigram its bigram, of each bigram its words.
        self.context = {4: context.take(at4)}
        pair4, last4 = pair.take(at4), c3.take(at4)
        del context, pair
        self.three_of, at3 = ranked(pair4, last4, (rows_, words))
        before3, last3, self.context[3] = c2.take(at4.take(at3)), last4.take(at3), pair4.take(at3)
        del c2, pair4, last4
        two_of, at2 = ranked(before3, last3, (words, words))
        self.two_of, self.context[2] = two_of, before3.take(at2)
        self.last, self.c3 = last3.take(at2), c3
        del before3, last3
        by_half = np.bincount(2 * self.four + self.half, minlength=2 * len(at4)).reshape(-1, 2)
        self.counts = {4: [np.ascontiguousarray(by_half[:, h]) for h in HALVES]}
        del by_half
        self.counts[3] = [np.bincount(self.three_of[self.counts[4][h] > 0], minlength=len(at3)) for h in HALVES]
        self.counts[2] = [np.bincount(two_of[self.counts[3][h] > 0], minlength=len(at2)) for h in HALVES]
        # What is asked: the last words, ascending, and the bigrams after hot words, by range of the last word.
        present = np.zeros(words, bool)
        present[self.last] = True
        self.range_of = ((self.hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        asked = np.flatnonzero(present)
        self.asked = asked[np.argsort(self.range_of[asked], kind="stable")]
        self.place = np.zeros(words, np.int64)
        self.place[self.asked] = np.arange(len(asked))
        self.hot = np.isin(self.hashes, hot)[self.context[2]]


FIRST = "bucket int, range int, body binary, counts array<long>"


def _table(rows: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    names = ("bucket", "range", "body", "counts")
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, types))})


def counted(positions: DataFrame, hot: np.ndarray, common: Broadcast[Common], ranges: int) -> DataFrame:
    """What each bucket asks for, by range, and (range -1) its counts of counts."""

    def run(group: pa.Table) -> pa.Table:
        number = group.column("bucket")[0].as_py()
        b = Bucket(list(zip(group.column("source").to_pylist(), group.column("body").to_pylist())), hot, common.value, ranges)
        often = [x for n in (4, 3) for h in HALVES for x in _often(b.counts[n][h])]
        often += [x for h in HALVES for x in _often(b.counts[2][h][~b.hot])]
        rows = [(number, -1, None, often)]
        after = [np.bincount(b.place[b.last[~b.hot & (b.counts[2][h] > 0)]], minlength=len(b.asked)) for h in HALVES]
        asked_range = b.range_of[b.asked]
        for part in np.unique(asked_range).tolist():
            start, end = np.searchsorted(asked_range, [part, part + 1])
            at = np.flatnonzero(b.hot & (b.range_of[b.last] == part))
            asked = b.asked[start:end]
            ranked_, others = asked[asked < len(common.value.hashes)], b.hashes[asked[asked >= len(common.value.hashes)]]
            rows.append(
                (
                    number,
                    part,
                    pack(
                        np.diff(ranked_, prepend=0),
                        np.diff(others, prepend=np.uint64(0)),
                        *[after[h][start:end] for h in HALVES],
                        b.place[b.last[at]] - start,
                        b.hashes[b.context[2][at]],
                        *[b.counts[2][h][at] for h in HALVES],
                    ),
                    None,
                )
            )
        return _table(rows)

    return positions.groupBy("bucket").applyInArrow(run, FIRST)


def answered(asked: DataFrame, common: Broadcast[Common]) -> DataFrame:
    """Sums over all buckets, in the order asked; bucket -1 has the counts of one range, bucket -2 one hot word's.

    A range's counts: how many words there are, and by half the sum of their counts
    and how many are 1, 2, 3, 4 and at least 3; then how many counts of hot words'
    bigrams are 1 to 4.  A hot word's: itself, and by half the sum of its bigrams'
    counts and how many are 1, 2 and at least 3.
    """

    def run(group: pa.Table) -> pa.Table:
        part = group.column("range")[0].as_py()
        numbers = group.column("bucket").to_pylist()
        parts = [unpack(body.as_buffer()) for body in group.column("body")]
        lists = [np.concatenate([common.value.hashes[np.cumsum(p[0].astype(np.int64))], np.cumsum(p[1].astype(np.uint64))]) for p in parts]
        hashes, own = np.unique(np.concatenate(lists), return_inverse=True)
        starts = np.cumsum([0, *[len(x) for x in lists]])
        sums = [np.bincount(own, np.concatenate([p[2 + h] for p in parts]), len(hashes)).astype(np.int64) for h in HALVES]
        last = np.concatenate([own[s:][p[4]] for p, s in zip(parts, starts)])
        before, before_code = np.unique(np.concatenate([p[5].astype(np.uint64) for p in parts]), return_inverse=True)
        two, at = ranked(before_code, last, (len(before), len(hashes)))
        twos = [np.bincount(two, np.concatenate([p[6 + h] for p in parts]), len(at)).astype(np.int64) for h in HALVES]
        for h in HALVES:
            sums[h] += np.bincount(last[at][twos[h] > 0], minlength=len(hashes))
        rows, start2 = [], 0
        for number, p, x, start in zip(numbers, parts, lists, starts):
            mine, mine2 = own[start : start + len(x)], two[start2 : start2 + len(p[4])]
            start2 += len(p[4])
            rows.append((number, part, pack(*[s[mine] for s in sums], *[t[mine2] for t in twos]), None))
        counts = [len(hashes)]
        for h in HALVES:
            counts += [int(sums[h].sum()), *_often(sums[h]), int((sums[h] > 2).sum())]
        rows.append((-1, part, None, counts + [x for h in HALVES for x in _often(twos[h])]))
        whose = before_code[at]
        each = [before.view(np.int64)]
        for h in HALVES:
            each.append(np.bincount(whose, twos[h], len(before)).astype(np.int64))
            each += [np.bincount(whose[mask], minlength=len(before)) for mask in (twos[h] == 1, twos[h] == 2, twos[h] > 2)]
        rows += [(-2, part, None, [int(x[k]) for x in each]) for k in range(len(before))]
        return _table(rows)

    return asked.groupBy("range").applyInArrow(run, FIRST)


class Smoothing(NamedTuple):
    """Discounts by order and half, sums over all words by half, and hot words' sums."""

    discounts: dict[int, list[np.ndarray]]
    vocabulary: int
    all_words: list[tuple[int, float]]
    hot: np.ndarray
    hot_sums: list[tuple[np.ndarray, np.ndarray]]


def _added(rows: DataFrame) -> list[int]:
    """The sums of ``counts``, number by number."""
    found = rows.select(F.posexplode("counts").alias("at", "count")).groupBy("at").agg(F.sum("count").alias("count")).collect()
    return [r["count"] for r in sorted(found, key=lambda r: r["at"])]


def smoothing(asked: DataFrame, answers: DataFrame, hot: np.ndarray) -> Smoothing:
    often = _added(asked.filter("range = -1"))
    words = _added(answers.filter("bucket = -1"))
    two = [often[16 + k] + words[13 + k] for k in range(8)]
    d = {4: [discounts(*often[4 * h : 4 * h + 4]) for h in HALVES], 3: [discounts(*often[8 + 4 * h : 12 + 4 * h]) for h in HALVES]}
    d[2] = [discounts(*two[4 * h : 4 * h + 4]) for h in HALVES]
    d[1] = [discounts(*words[2 + 6 * h : 6 + 6 * h]) for h in HALVES]
    all_words = []
    for h in HALVES:
        total, n1, n2, _, _, more = words[1 + 6 * h : 7 + 6 * h]
        all_words.append((total, float(np.dot(d[1][h], [n1, n2, more]))))
    counts = [F.col("counts")[k] for k in range(9)]
    sums = [F.sum(c).alias(f"s{k}") for k, c in enumerate(counts) if k]
    rows = answers.filter("bucket = -2").groupBy(counts[0].alias("word")).agg(*sums).collect()
    by_word = {r["word"]: [r[f"s{k}"] for k in range(1, 9)] for r in rows}
    own = np.array([by_word.get(w, [0] * 8) for w in hot.view(np.int64).tolist()], np.float64).reshape(-1, 8)
    hot_sums = [(own[:, 4 * h], own[:, 4 * h + 1 : 4 * h + 4] @ d[2][h]) for h in HALVES]
    return Smoothing(d, words[0], all_words, hot, hot_sums)


def chances(b: Bucket, replies: list[tuple[int, bytes]], model: Smoothing) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By half, the chance of each four-gram's last word after the others, and of each word that was asked by itself."""
    parts = [unpack(body) for _, body in sorted(replies)]
    part_of = b.range_of[b.last]
    single, four = [], []
    for h in HALVES:
        total, cut = model.all_words[h]
        counts = np.concatenate([p[h] for p in parts]).astype(np.int64)
        least = 1.0 / (model.vocabulary + 1)  # one more for a word never seen
        p = (counts - _cut(counts, model.discounts[1][h]) + cut * least) / total if total else np.full(len(counts), least)
        single.append(p)
        p = p.take(b.place.take(b.last))
        whole = b.counts[2][h].copy()
        for (part, _), reply in zip(sorted(replies), parts):
            whole[b.hot & (part_of == part)] = reply[2 + h]
        for n, of in ((2, None), (3, b.two_of), (4, b.three_of)):
            counts, context = whole if n == 2 else b.counts[n][h], b.context[n]
            cuts = _cut(counts, model.discounts[n][h])
            size = int(context.max()) + 1
            total, cut = (np.bincount(context, x, size).take(context) for x in (counts, cuts))
            if n == 2 and b.hot.any():
                at = np.searchsorted(model.hot, b.hashes[context[b.hot]])
                total[b.hot], cut[b.hot] = (s[at] for s in model.hot_sums[h])
            lower = p if of is None else p.take(of)
            seen = total > 0
            total[~seen] = 1
            p = np.where(seen, (counts - cuts + cut * lower) / total, lower)
        four.append(p)
    return four, single


def scored(positions: DataFrame, replies: DataFrame, model: Smoothing, common: Broadcast[Common], ranges: int) -> DataFrame:
    """``slice, body``: texts by difference, and sums of millionths of all words and of single ones, and the words of the mean."""
    millionths = lambda p: np.maximum(np.rint(-1e6 * np.log(p)), 0)
    # Replies have sources below zero, by range.
    both = positions.unionByName(replies.select("bucket", (-1 - F.col("range")).cast("long").alias("source"), "body"))

    def run(group: pa.Table) -> pa.Table:
        rows = list(zip(group.column("source").to_pylist(), group.column("body").to_pylist()))
        b = Bucket([r for r in rows if r[0] >= 0], model.hot, common.value, ranges)
        four, single = chances(b, [(-1 - s, body) for s, body in rows if s < 0], model)
        # A text is scored by the counts of the other half.
        other = (1 - b.half).astype(np.int64)
        cost = np.concatenate([millionths(p) for p in four]).take(other * len(four[0]) + b.four)
        alone = np.concatenate([millionths(p) for p in single]).take(other * len(single[0]) + b.place.take(b.c3))
        lettered = b.flags.take(b.c3)
        found, start = [], 0
        for size, docs, met in zip(b.sizes, b.docs, b.met):
            part = slice(start, start + size)
            start += size
            sums = [np.bincount(docs, x, len(met)).astype(np.int64) for x in (cost[part], alone[part] * lettered[part], lettered[part])]
            found.append(pack(np.diff(met, prepend=0), *sums))
        return pa.table({"slice": pa.array(b.sources, pa.int64()), "body": pa.array(found, pa.binary())})

    def added(group: pa.Table) -> pa.Table:
        sums = by_place(group.column("body"))
        met = np.flatnonzero(sums[0])
        body = pack(np.diff(met, prepend=0), *[s[met] for s in sums[1:]])
        return pa.table({"slice": group.column("slice").slice(0, 1), "body": pa.array([body], pa.binary())})

    each = both.groupBy("bucket").applyInArrow(run, "slice long, body binary")
    return each.groupBy("slice").applyInArrow(added, "slice long, body binary")


def by_place(bodies: Iterable, texts: int = 0) -> list[np.ndarray]:
    """By a text's place in its slice: in how many bodies it is, and its sums."""
    parts = [unpack(body.as_buffer()) for body in bodies]
    if not parts:
        return [np.zeros(texts, np.int64)] * 4
    places = np.concatenate([np.cumsum(p[0].astype(np.int64)) for p in parts])
    sums = [np.bincount(places, np.concatenate([p[k] for p in parts]), texts).astype(np.int64) for k in (1, 2, 3)]
    return [np.bincount(places, minlength=texts), *sums]


def by_text(slices: DataFrame, sums: DataFrame) -> DataFrame:
    """``t, all, single, words`` of each text of each slice."""

    def run(group: pa.Table) -> pa.Table:
        keys = next(unpack(key.as_buffer())[0] for key in group.column("keys") if key.is_valid).astype(np.uint64).view(np.int64)
        _, *sums = by_place((body for body in group.column("body") if body.is_valid), len(keys))
        return pa.table({"t": keys, **{n: s for n, s in zip(("all", "single", "words"), sums)}})

    no = F.lit(None).cast("binary")
    both = slices.select("slice", "keys", no.alias("body")).unionByName(sums.select("slice", no.alias("keys"), "body"))
    return both.groupBy("slice").applyInArrow(run, "t long, all long, single long, words long")


def text_costs(docs: DataFrame, coded: Callable, sizes: Sizes = Sizes()) -> tuple[DataFrame, list[str]]:
    """``t, all, single, words`` of ``docs(t, text)`` by slice, and the scratch tables it reads.

    ``all`` and ``single`` are minus the logarithms of the words' chances in
    millionths, after the three words before and by themselves, added over the text.
    The first counts all words, the second and ``words`` those of the mean.  A text is
    scored by the counts of the texts whose ``t`` is odd where its own is even, and
    the other way round.
    """
    spark, folders = docs.sparkSession, []

    def kept(df: DataFrame, name: str) -> DataFrame:
        folders.append(scratch_path(spark, name))
        out = _stored_at(df, folders[-1])
        shuffles_released(spark)
        return out

    slices = kept(slices_of(docs, coded, sizes), "slices")
    total = slices.agg(F.sum("words")).first()[0] or 0
    passes = min(sizes.passes, max(1, total // sizes.pass_words))
    buckets = passes * max(min(6, -(-total // 100_000)), -(-total // (passes * sizes.bucket_words)), 1)
    ranges = max(min(8, buckets), -(-total // sizes.range_words))
    hot = hot_words(slices, total, sizes.hot_words)
    common = spark.sparkContext.broadcast(common_words(slices, sizes.common_words))
    shuffles_released(spark)
    asked = [kept(counted(dealt(slices, k, passes, buckets, hot, common), hot, common, ranges), "asked") for k in range(passes)]
    every = asked[0]
    for one in asked[1:]:
        every = every.unionByName(one)
    answers = None
    turns = min(sizes.answer_turns, ranges)
    for k in range(turns):
        these = every.filter((F.col("range") >= 0) & (F.col("range") % turns == k))
        one = kept(answered(these.select("bucket", "range", "body"), common), "answers")
        answers = one if answers is None else answers.unionByName(one)
    if not total:
        return by_text(slices, answers.select(F.lit(0).cast("long").alias("slice"), "body")), folders
    model = smoothing(every, answers, hot)
    for path in folders[1 : 1 + passes]:
        removed(spark, path)
    folders[1 : 1 + passes] = []
    sums = None
    for k in range(passes):
        replies = answers.filter((F.col("bucket") >= 0) & (F.col("bucket") % passes == k))
        one = kept(scored(dealt(slices, k, passes, buckets, hot, common), replies, model, common, ranges), "sums")
        sums = one if sums is None else sums.unionByName(one)
    return by_text(slices, sums), folders
