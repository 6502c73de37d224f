"""Token counts that follow edits without encoding a text again.

A text is a row of segments, each white space and the word after it: a byte-level
tokenizer never joins across the end of a word before white space, so a
segment's tokens do not depend on its neighbours.  A segment of more than ``LONG``
characters is cut on where its own tokens end: merges never crossed such a place,
so both sides have the same tokens by themselves.  Leaves hold about ``LEAF``
of these pieces; a complete binary tree above them holds the sums of their characters
and tokens.  An edit finds its leaves by descending on character sums, encodes
the segments it touches together with the one before and the one after, and
updates the sums on the way up.  Where the edited stretch meets a neighbour without
white space between, both are encoded together and by themselves, and the stretch
grows by a leaf until the two agree: a row of tokens is the encoding of its text if
each pair of neighbours is that of theirs.  The leaves' sums can be stored with the
text, so the next edits start from them.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, table, text_slices
from shelfmark.llm.registry import query

LEAF = 32
# Segments of more characters are cut into pieces of at least PIECE.
LONG, PIECE = 256, 16
CACHED_SEGMENTS = 400_000
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"

# White space as the tokenizer's pattern has it.
_WIDE_SPACE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = f"\t-\r {_WIDE_SPACE}"
_SEGMENT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_HAS_WIDE_SPACE = re.compile(f"[{_WIDE_SPACE}]")
_IS_SPACE = re.compile(f"[{_SPACE}]")
_MARK = "\x01"


def segments(text: str) -> list[str]:
    """The text cut before each run of white space that follows a word."""
    return _SEGMENT.findall(text)


class SegmentEncoder:
    """Token counts of segments under a byte-level tokenizer, kept for segments seen before."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.mark = self.ids(f" {_MARK}")
        self.known: dict[str, int] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)

    def counts(self, wanted: list[str]) -> list[int]:
        """The number of tokens of each segment."""
        fresh = [s for s in dict.fromkeys(wanted) if s not in self.known and len(s) <= LONG]
        if fresh and len(self.known) + len(fresh) > CACHED_SEGMENTS:
            self.known = {}
            fresh = [s for s in dict.fromkeys(wanted) if len(s) <= LONG]
        # Segments between white space go many to a string, a mark after each.
        joined = [s for s in fresh if s[0] in " \n\t\r" and not s[-1].isspace() and _MARK not in s]
        for at in range(0, len(joined), 256 * 64):
            groups = [joined[k : k + 256] for k in range(at, min(at + 256 * 64, len(joined)), 256)]
            texts = [f" {_MARK}".join([*group, ""]) for group in groups]
            for group, encoded in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ends = np.flatnonzero(np.array(encoded.ids) == self.mark[-1])
                sizes = np.diff(np.concatenate([[-1], ends])) - len(self.mark)
                self.known.update(zip(group, sizes.tolist()))
        for segment in fresh:
            if segment not in self.known:
                self.known[segment] = len(self.ids(segment))
        found = list(map(self.known.get, wanted))
        return [len(self.ids(s)) if n is None else n for s, n in zip(wanted, found)] if None in found else found

    def pieces(self, segment: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the pieces of a long segment.

        Cut where a token ends with a whole character, but not before an
        apostrophe, which with the letter after it can be a word of its own.
        """
        found = np.array(self.tokenizer.encode(segment, add_special_tokens=False).offsets, np.int64)
        ends, starts = found[:-1, 1], found[1:, 0]
        chars, tokens, cut, token = [], [], 0, 0
        for k in np.flatnonzero(ends == starts).tolist():
            place = int(starts[k])
            if place - cut >= PIECE and segment[place] != "'" and not _IS_SPACE.match(segment[place - 1]):
                chars.append(place - cut)
                tokens.append(k + 1 - token)
                cut, token = place, k + 1
        return np.array([*chars, len(segment) - cut], np.int64), np.array([*tokens, len(found) - token], np.int64)

    def measured(self, own: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of segments, those of long ones piece by piece."""
        if all(len(s) <= LONG for s in own):
            return np.array([len(s) for s in own], np.int64), np.array(self.counts(own), np.int64)
        parts = [self.pieces(s) if len(s) > LONG else (np.array([len(s)]), np.array(self.counts([s]))) for s in own]
        return tuple(np.concatenate(column).astype(np.int64) for column in zip(*parts))

    def apart(self, left: str, right: str) -> bool:
        """Whether two stretches have the same tokens together as by themselves."""
        return np.array_equal(self.ids(left + right), np.concatenate([self.ids(left), self.ids(right)]))


class TokenTree:
    """A text with a heap of its leaves' character and token sums."""

    def __init__(self, text: str, leaf_chars: np.ndarray, leaf_tokens: np.ndarray, encoder: SegmentEncoder):
        self.base, self.encoder = text, encoder
        self.starts = np.cumsum(leaf_chars) - leaf_chars
        self.sizes = leaf_chars
        self.changed: dict[int, str] = {}
        self.encoded = self.encoded_chars = 0
        # Whether leaves meet within a segment; an edit makes no such place.
        self.unbroken = any(self._meets(text[k - 1], text[k]) for k in self.starts.tolist() if 0 < k < len(text))
        self.count = max(1, len(leaf_chars))
        self.width = 1 << (self.count - 1).bit_length()
        self.chars, self.tokens = (self._heap(x) for x in (leaf_chars, leaf_tokens))

    @classmethod
    def build(cls, text: str, encoder: SegmentEncoder) -> TokenTree:
        return cls(text, *leaf_sums(*encoder.measured(segments(text))), encoder)

    def _heap(self, leaves: np.ndarray) -> list[int]:
        level = np.zeros(self.width, np.int64)
        level[: len(leaves)] = leaves
        levels = [level]
        while len(level) > 1:
            level = level[0::2] + level[1::2]
            levels.append(level)
        return [0, *np.concatenate(levels[::-1]).tolist()]

    def leaf(self, k: int) -> str:
        if k in self.changed:
            return self.changed[k]
        return self.base[self.starts[k] : self.starts[k] + self.sizes[k]] if k < len(self.sizes) else ""

    def text(self) -> str:
        return "".join(self.leaf(k) for k in range(self.count)) if self.changed else self.base

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        return tuple(heap[self.width : self.width + self.count] for heap in (self.chars, self.tokens))

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, or the last one, and where that leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def edit(self, start: int, end: int, text: str) -> None:
        """Put ``text`` in place of the characters from ``start`` to ``end``; both are held to the text."""
        start = min(max(start, 0), self.chars[1])
        end = min(max(end, start), self.chars[1])
        # From the segment of the character before the edit to that of the one after it:
        # the outer ends of these two stay ends of segments.
        (first, first_at), (last, last_at) = self.find(max(start - 1, 0)), self.find(end)
        before, low = segments(self.leaf(first)), first_at
        for skipped, segment in enumerate(before):
            if low + len(segment) >= start:
                before = before[:skipped]
                break
            low += len(segment)
        after, high = segments(self.leaf(last)), last_at
        for passed, segment in enumerate(after):
            high += len(segment)
            if high > end:
                after = after[passed + 1 :]
                break
        else:
            after = []
        old = "".join(self.leaf(k) for k in range(first, last + 1))
        fresh = segments(old[low - first_at : start - first_at] + text + old[end - first_at : high - first_at])
        self.encoded += len(fresh)
        own, wider = [*before, *fresh, *after], None
        if self.unbroken:
            wider = self._widened(first, first_at, last, last_at, "".join(own))
            first, last, own = wider or (first, last, own)
        new = set(fresh)
        self.encoded_chars += sum(len(s) for s in own if s in new or len(s) > LONG or wider)
        self._put(first, "".join(own), sum(self.encoder.counts(own)))
        for k in range(first + 1, last + 1):
            self._put(k, "", 0)

    def _widened(self, first: int, first_at: int, last: int, last_at: int, new: str) -> tuple[int, int, list[str]] | None:
        """The leaves whose text ``new`` takes the place of and its segments, grown until its ends are ends of tokens; None if they are."""
        end, grown, more = last_at + len(self.leaf(last)), False, True
        while more:
            more = False
            if first_at:
                k, at = self.find(first_at - 1)
                left = self.leaf(k)
                if self._meets(left, new) and not self._apart(left, new, 0):
                    first, first_at, new, more = k, at, left + new, True
            if end < self.chars[1]:
                k, at = self.find(end)
                right = self.leaf(k)
                if self._meets(new, right) and not self._apart(right, new, -1):
                    last, end, new, more = k, at + len(right), new + right, True
            grown |= more
        return (first, last, segments(new)) if grown else None

    @staticmethod
    def _meets(left: str, right: str) -> bool:
        """Whether no white space parts two stretches; an empty one parts nothing."""
        return not (left and right) or not (_IS_SPACE.match(left[-1]) or _IS_SPACE.match(right[0]))

    def _apart(self, beside: str, new: str, side: int) -> bool:
        if not new:
            return False
        own = segments(new)
        near = segments(beside)[-1 if side == 0 else 0]
        pair = (near, own[0]) if side == 0 else (own[-1], near)
        self.encoded_chars += len(pair[0]) + len(pair[1])
        return self.encoder.apart(*pair)

    def _put(self, k: int, text: str, tokens: int) -> None:
        self.changed[k] = text
        node = self.width + k
        more = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def leaf_sums(chars: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over leaves of ``LEAF`` segments."""
    at = np.arange(0, len(chars), LEAF)
    return (np.add.reduceat(chars, at), np.add.reduceat(tokens, at)) if len(at) else (chars, tokens)


def segment_sums(texts: pa.Array, encoder: SegmentEncoder) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's segments as arrays of character and token counts.

    Segments are cut on the bytes of all texts at once and each distinct one is
    counted once; the few texts with white space beyond ASCII are cut one by one.
    """
    texts = texts.cast(pa.large_string())
    wide = pc.match_substring_regex(texts, f"[{_WIDE_SPACE}]").to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(wide), "", texts)
    raw = np.frombuffer(data := b"".join(t.as_buffer() for t in plain), np.uint8)
    ends = np.cumsum(pc.binary_length(plain).to_numpy(zero_copy_only=False)).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    cut[starts], cut[-1] = True, True
    at = np.flatnonzero(cut) if len(raw) else np.zeros(1, np.int64)
    found = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
    coded = found.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary.to_pylist()
    long = {k: encoder.pieces(s) for k, s in enumerate(distinct) if len(s) > LONG}
    counts = np.zeros(len(distinct), np.int64)
    counts[[k for k in range(len(distinct)) if k not in long]] = encoder.counts([s for s in distinct if len(s) <= LONG])
    tokens = counts[codes] if len(codes) else np.zeros(0, np.int64)
    leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    chars = np.diff(leads[at])
    place = np.searchsorted(at, np.concatenate([starts, ends[-1:]]))
    out = [(chars[a:b], tokens[a:b]) for a, b in zip(place[:-1], place[1:])]
    if long:
        before = np.concatenate([[0], np.cumsum(np.isin(codes, list(long)))])
        for row in np.flatnonzero(np.diff(before[place])).tolist():
            a, b = place[row], place[row + 1]
            parts = [long.get(k, (chars[j : j + 1], tokens[j : j + 1])) for j, k in enumerate(codes[a:b].tolist(), a)]
            out[row] = tuple(np.concatenate(column) for column in zip(*parts))
    for row in np.flatnonzero(wide).tolist():
        out[row] = encoder.measured(segments(texts[row].as_py()))
    return out


_OPEN: dict[str, SegmentEncoder] = {}


def segment_encoder(path: str) -> SegmentEncoder:
    """The encoder of this worker; its counts outlive a task."""
    if path not in _OPEN:
        _OPEN[path] = SegmentEncoder(path)
    return _OPEN[path]


TREE = "leaf_chars array<long>, leaf_tokens array<long>"


def apply_edits(docs: DataFrame, tokenizer: str, keep: bool = False) -> DataFrame:
    """Edit each row of ``docs(doc_id, text, edits)`` and count its tokens before and after.

    ``edits`` are applied in order, each to the text the ones before it left;
    places outside the text are moved to its ends, null ends or texts of an edit
    count as 0 and empty.  With columns ``leaf_chars`` and ``leaf_tokens``, as
    ``keep`` returns them beside the new text, a row's tree is taken from there.

    A null text is an empty one, null ``edits`` are none.  Null and repeated ids
    are passed through row by row; other columns are ignored; an empty table
    gives no rows.
    """
    stored_tree = {"leaf_chars", "leaf_tokens"} <= set(docs.columns)
    schema = "doc_id long, n_edits long, n_segments long, n_encoded long, chars_encoded long, tokens_before long, tokens_after long, chars_after long, text_crc32 long"
    schema += (", text string, " + TREE) * keep
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = segment_encoder(tokenizer)
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            if stored_tree:
                leaves = [[np.array(x or [], np.int64) for x in batch.column(c).to_pylist()] for c in ("leaf_chars", "leaf_tokens")]
                sums = list(zip(*leaves))
                counts = [-1] * len(sums)
            else:
                found = segment_sums(texts, encoder)
                sums, counts = [leaf_sums(*x) for x in found], [len(x[0]) for x in found]
            rows: list[tuple] = []
            for text, (chars, tokens), count, edits in zip(texts.to_pylist(), sums, counts, batch.column("edits").to_pylist()):
                tree = TokenTree(text, chars, tokens, encoder)
                before = tree.tokens[1]
                for edit in edits or []:
                    tree.edit(edit["start"] or 0, edit["end"] or 0, edit["text"] or "")
                new = tree.text()
                row = (len(edits or []), count, tree.encoded, tree.encoded_chars, before, tree.tokens[1], tree.chars[1], zlib.crc32(new.encode()))
                rows.append(row + ((new, *tree.leaf_sums()) if keep else ()))
            types = [pa.int64()] * 8 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())] * keep
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    wanted = ["doc_id", "text", "edits", *(["leaf_chars", "leaf_tokens"] if stored_tree else [])]
    return map_arrow(docs.select(*wanted), run, schema)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with an ``edits`` column from ``edits(doc_id, seq, start, end, text)``, in order of ``seq``."""
    entry = F.struct("seq", "start", "end", "text")
    lists = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(entry)).alias("_found_edits"))
    bare = F.transform("_found_edits", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["text"].alias("text")))
    return docs.join(lists, "doc_id", "left").withColumn("edits", bare.cast(EDITS)).drop("_found_edits")


def sample_edits(text: Column) -> Column:
    """Four edits at places that follow from the text's length: replace, insert, delete, append."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")

    def edit(start: Column, end: Column, new: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), new.alias("text"))

    quarter, half, eighth = F.floor(n / 4), F.floor(n / 2), F.floor(n / 8)
    return F.array(
        edit(quarter, quarter + 16, F.coalesce(F.substring(text, 1, 12), F.lit(""))),
        edit(half, half, F.lit(" an inserted note, ")),
        edit(eighth, eighth + 40, F.lit("")),
        edit(n + 64, n + 64, F.lit("\nThe end.")),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op10_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_edits(docs.select("doc_id", "text", sample_edits(F.col("text")).alias("edits")), default_tokenizer())
