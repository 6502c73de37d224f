"""Personal data: exact base rules, and boosted trees over high-recall candidates.

The base rules find well-formed e-mail addresses, IP addresses, cards and phone
numbers.  Generators propose overlapping spans far more freely; trees over
features of their format and context score each proposal, and a span is added
where the score passes its kind's threshold and no base span overlaps.

The trees learn from all documents: base spans, and the same spans
written in other ways (spelled-out, spaced or bracketed signs, other separators,
no plus), are positive; other proposals, and base spans broken so that they no longer check,
are negative.  Thresholds are the lowest with the wanted precision on held-out
documents.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import _stored_at, ddl, map_arrow, removed, table, text_slices
from shelfmark.llm.registry import query
from shelfmark.llm.trees import BoostedTrees, unpacked
from shelfmark.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
# So many examples of one text are counted at a time.
PART = 1 << 16
PRECISION, SCORES = 0.99, 10_000
# No kind of number is longer.
MOST_DIGITS = 19
CONTEXT = 24

Span = tuple[str, int, int]

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

_AT = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?")
_NAME_BEFORE = re.compile(r"[\w.%+-]{1,64}\Z")
_HOST_AFTER = re.compile(r"[\w-]{1,63}(?:(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?)[\w-]{1,63}){1,8}")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[0-9().\-/]|\x20(?=[0-9().\-/])){5,}")
# Four numbers with dots between them, the dots spaced, in brackets or spelled out.
_DOT = r"\x20?(?:\.|\[\.\]|\(\.\)|\{\.\}|\(dot\)|\[dot\])\x20?"
_DOTTED = re.compile(rf"[0-9]+(?:{_DOT}[0-9]+){{3,}}")
_CUES = re.compile(r"tel|phone|fon|call|mail|card|karte|tarjeta|carte|ip\b|addr|contact", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base rules' spans by start, then kind."""
    found: list[Span] = []
    at = text.find("@")
    end = 0
    while at >= 0:  # the same matches as a scan for the whole pattern, without its retries
        local = _LOCAL.search(text, max(end, _run_start(text, at, end)), at)
        match = local and _DOMAIN.match(text, at)
        if match:
            found.append(("email", local.start(), match.end()))
            end = match.end()
        at = text.find("@", max(at + 1, end))
    for match in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in match.group().split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
            found.append(("phone", *match.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _run_start(text: str, at: int, end: int) -> int:
    while at > end and text[at - 1] in _LOCAL_CHARS:
        at -= 1
    return at


def proposals(text: str) -> list[Span]:
    """Overlapping spans that may be personal data, each with a kind."""
    found: set[Span] = set()
    for match in _AT.finditer(text):
        before = _NAME_BEFORE.search(text, max(0, match.start() - 64), match.start())
        after = _HOST_AFTER.match(text, match.end())
        if before and after:
            found.add(("email", before.start(), after.end()))
    for match in _DOTTED.finditer(text):
        groups = [g.span() for g in _DIGITS.finditer(text, *match.span())]
        for four in zip(groups, groups[1:], groups[2:], groups[3:]):
            if all(end - start <= 3 for start, end in four):
                found.add(("ip", four[0][0], four[3][1]))
    for match in _NUMBER.finditer(text):
        groups = [g.span() for g in _DIGITS.finditer(text, *match.span())]
        for first, (start, _) in enumerate(groups):
            for opening in "(+":
                start -= start > match.start() and text[start - 1] == opening
            digits = 0
            # Every run of whole groups of digits from here; each has a digit, so at most MOST_DIGITS of them.
            for last in range(first, min(len(groups), first + MOST_DIGITS)):
                end = groups[last][1]
                digits += end - groups[last][0]
                if digits > MOST_DIGITS:
                    break
                if 7 <= digits <= 15:
                    found.add(("phone", start, end))
                if 12 <= digits <= MOST_DIGITS:
                    found.add(("card", start, end))
                if 4 <= digits <= 12 and last - first == 3:
                    found.add(("ip", start, end))
    return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def _side(char: str) -> int:
    return 0 if not char or char.isspace() else 1 if char.isalpha() else 2 if char.isdigit() else 3


def features(text: str, span: Span) -> list[int]:
    """Format and context of a proposal as whole numbers."""
    kind, start, end = span
    own = text[start:end]
    groups = _DIGITS.findall(own)
    digits = "".join(groups)
    left, right = text[max(0, start - CONTEXT) : start], text[end : end + 2]
    sizes = [len(g) for g in groups] or [0]
    return [
        KINDS.index(kind),
        end - start,
        len(digits),
        sum(c.isalpha() for c in own),
        own.count(" "),
        own.count("."),
        own.count("-"),
        own.count("(") + own.count("["),
        own.count("/"),
        own.startswith("+"),
        own.startswith("("),
        len(groups),
        max(sizes),
        min(sizes),
        sizes[0],
        sizes[-1],
        12 <= len(digits) <= 19 and luhn(digits),
        len(groups) == 4 and all(int(g[:9]) <= 255 for g in groups),
        "@" in own,
        own.count("dot"),
        _side(left[-1:]),
        _side(right[:1]),
        bool(_CUES.search(left)),
        left.rstrip(" ")[-1:].isdigit(),
        text[end : end + CONTEXT].lstrip(" ")[:1].isdigit(),
    ]


FEATURES = len(features("0", ("email", 0, 1)))
_PACKED = f"<{FEATURES}i"


def _rewritten(kind: str, own: str) -> tuple[list[str], list[str]]:
    """Other ways to write a base span, and broken forms of it."""
    groups = _DIGITS.findall(own)
    digits = "".join(groups)
    if kind == "email":
        name, host = own.split("@")
        good = [f"{name}{a}{host.replace('.', d)}" for a, d in (("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", "."))]
        return good, []
    if kind == "ip":
        dots = (" . ", "[.]", "(.)", "(dot)", " [dot] ", " (dot) ")
        good = [dot.join(groups) for dot in dots]
        high = [str(int(groups[0]) + 256), *groups[1:]], [*groups[:3], "999"]
        # Other signs between four numbers make a date, a range or a number of some kind.
        return good, [dot.join(four) for four in high for dot in (".", *dots)] + [sign.join(groups) for sign in ("-", " ", "/")]
    if kind == "card":
        quads = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        broken = digits[:-1] + str((int(digits[-1]) + 1 + len(digits) % 8) % 10)
        wrong = [broken[k : k + 4] for k in range(0, len(broken), 4)]
        return [".".join(quads), "/".join(quads)], [broken, " ".join(wrong), ".".join(wrong), digits[:11], digits + "00000"]
    if len(digits) < 10:
        return [], []
    local = digits[-10:]
    good = [f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"{digits[:-10]}-{local[:3]}-{local[3:6]}-{local[6:]}"]
    return good, [digits[-8:], local, f"{local[:4]}-{local[4:6]}-{local[6:8]}", f"{local[:2]}.{local[2:4]}.{local[4:8]}"]


# Numbers that stand around a card or phone: dates of expiry, check numbers, years.
_AROUND = (("", " 12/26"), ("", " 123"), ("2024 ", ""), ("17 ", " 09/27 481"), ("2023-10-05 ", " 7"))


def examples(text: str) -> Iterator[tuple[list[int], int]]:
    """Features and labels of one document's proposals and of rewritten base spans.

    Proposals that meet another span of the base rules are left out, as they are
    never added; so are those that are well-formed by themselves, which the base
    rules may have missed for the numbers around them.
    """
    base = base_spans(text)
    known, covered = set(base), bytearray(len(text))
    for _, start, end in base:
        covered[start:end] = b"\1" * (end - start)
    for span in proposals(text):
        kind, start, end = span
        if span in known or not any(covered[start:end]) and (kind, 0, end - start) not in base_spans(text[start:end]):
            yield features(text, span), int(span in known)
    for kind, start, end in base:
        own = text[start:end]
        left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        forms = _rewritten(kind, own)
        for label, each in zip((1, 0), forms):
            for form in each:
                new, wanted = left + form + right, (len(left), len(left) + len(form))
                for span in proposals(new):
                    if span[1:] == wanted:
                        yield features(new, span), int(label and span[0] == kind)
        if kind not in ("card", "phone"):
            continue
        turn = zlib.crc32(own.encode())
        digits = "".join(_DIGITS.findall(own))
        quads = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        if len(digits) == 15:
            quads = [digits[:4], digits[4:10], digits[10:]]
        spaced = [" ".join(quads), "-".join(quads)] if kind == "card" else []  # by themselves these are base spans
        for k, form in enumerate([own, *forms[0], *spaced]):
            for step in range(3):
                before, after = _AROUND[(turn + k + step) % len(_AROUND)]
                new = left + before + form + after + right
                wanted = (len(left) + len(before), len(left) + len(before) + len(form))
                for span in proposals(new):
                    # A part of an international number is a number too, but not the one to add.
                    part = form[0] == "+" and span[1:] != wanted and span[1] >= wanted[0] and span[2] <= wanted[1]
                    if span[1] < wanted[1] and span[2] > wanted[0] and not part:
                        yield features(new, span), int(span == (kind, *wanted))


class Detector:
    """The trees and a threshold for each kind."""

    def __init__(self, trees: BoostedTrees | None, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Base spans with those the trees add, by start, then kind."""
        found = proposals(text) if self.trees else []
        if not found:
            return base
        scores = self.trees.predict(np.array([features(text, s) for s in found]))
        taken, covered = list(base), bytearray(len(text))
        for _, start, end in base:
            covered[start:end] = b"\1" * (end - start)
        for score, span in sorted(zip(scores, found), key=lambda x: (-x[0], x[1][1], x[1])):
            kind, start, end = span
            if score >= self.thresholds[kind] and not any(covered[start:end]):
                taken.append(span)
                covered[start:end] = b"\1" * (end - start)
        return sorted(taken, key=lambda s: (s[1], KINDS.index(s[0])))


def _hinted(texts: pa.Array) -> np.ndarray:
    """Texts that hold a digit or an at sign; only those can have a span."""
    return pc.match_substring_regex(texts, r"[0-9@]|\(at\)|\[at\]").to_numpy(zero_copy_only=False)


def _some(found: list, most: int, seed: int) -> list:
    """At most so many examples from all over a text, the same in every run; the trees no longer ask for it."""
    if len(found) <= most:
        return found
    return [found[k] for k in sorted(np.random.default_rng(seed).choice(len(found), most, replace=False))]


def counted_examples(docs: DataFrame) -> DataFrame:
    """``x, y, held, n``: packed features, label and count of the examples of all documents.

    Equal texts count once.  A quarter of the texts, by a checksum, is held out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            for row in np.flatnonzero(_hinted(texts)).tolist():
                text = texts[row].as_py()
                held = zlib.crc32(text.encode("utf-8", "replace")) % 4 == 0
                left, part = examples(text), 0
                # A part of a long text at a time; equal texts have equal parts.
                while found := Counter((struct.pack(_PACKED, *x), y) for x, y in islice(left, PART)):
                    size = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("t")[row].as_py()] * size, pa.int64()),
                            pa.array([part] * size, pa.int32()),
                            pa.array([x for x, _ in found], pa.binary()),
                            pa.array([y for _, y in found], pa.int32()),
                            pa.array([held] * size),
                            pa.array(found.values(), pa.int64()),
                        ],
                        names=["t", "part", "x", "y", "held", "n"],
                    )
                    part += 1

    texts = docs.select(F.xxhash64("text").alias("t"), "text")
    each = map_arrow(texts, run, "t long, part int, x binary, y int, held boolean, n long")
    once = each.groupBy("t", "part", "x", "y", "held").agg(F.max("n").alias("n"))
    return once.groupBy("x", "y", "held").agg(F.sum("n").alias("n"))


def precise_thresholds(trees: BoostedTrees, held: DataFrame) -> dict[str, float]:
    """For each kind the lowest score with the wanted precision on ``held(x, y, n)``; scores are cut to ten-thousandths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x"), "<i4", FEATURES)
            score = np.floor(trees.predict(x) * SCORES).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, 0].astype(np.int32)), pa.array(score), batch.column("y"), batch.column("n")],
                names=["kind", "score", "y", "n"],
            )

    scored = map_arrow(held.select("x", "y", "n"), run, "kind int, score int, y int, n long")
    sums = scored.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("good"))
    rows = sorted(sums.collect(), key=lambda r: -r["score"])  # at most SCORES + 1 of each kind
    found = dict.fromkeys(KINDS, np.inf)
    for k, kind in enumerate(KINDS):
        own = [r for r in rows if r["kind"] == k]
        every, good = np.cumsum([r["n"] for r in own]), np.cumsum([r["good"] for r in own])
        ok = np.flatnonzero(good >= PRECISION * every)
        if len(ok):
            # Where all held-out proposals pass, nothing asks for more than an even chance.
            found[kind] = 0.5 if ok[-1] == len(own) - 1 else max(0.5, own[ok[-1]]["score"] / SCORES)
    return found


def trained_detector(docs: DataFrame) -> Detector:
    """A detector fitted on the examples of all documents, with thresholds from all that are held out."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "examples")
    counted = _stored_at(counted_examples(docs), path)
    trees = BoostedTrees(FEATURES).fit(counted.filter("not held"))
    thresholds = precise_thresholds(trees, counted.filter("held")) if trees else {}
    removed(spark, path)
    return Detector(trees, thresholds)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_spans(docs: DataFrame, detector: Detector) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and all spans, of ``docs(doc_id, text)``.

    A null text is an empty one.  Null and repeated ids are passed through row
    by row; other columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(detector)
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            counts = np.zeros((len(KINDS), len(texts)), np.int64)
            digests, spans = [nothing] * len(texts), [""] * len(texts)
            for row in np.flatnonzero(_hinted(texts)).tolist():
                text = texts[row].as_py()
                base = base_spans(text)
                for kind, _, _ in base:
                    counts[KINDS.index(kind), row] += 1
                digests[row] = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans[row] = _joined(sent.value.spans(text, base))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *map(pa.array, counts), pa.array(digests), pa.array(spans)],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with spans replaced in ``text`` and ``n_chars``, if there, counted again."""
    sent = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            column = batch.column("text")
            texts = column.to_pylist()
            for row in np.flatnonzero(_hinted(pc.fill_null(column, ""))).tolist():
                spans = sent.value.spans(texts[row], base_spans(texts[row]))
                texts[row] = redacted(texts[row], spans) if spans else texts[row]
            new = pa.array(texts, pa.string())
            out = batch.set_column(batch.schema.get_field_index("text"), "text", new)
            if "n_chars" in out.schema.names:
                at = out.schema.get_field_index("n_chars")
                out = out.set_column(at, "n_chars", pc.utf8_length(new).cast(out.schema.field(at).type))
            yield out

    return map_arrow(docs, run, ddl(docs))


@query()
def op9_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_spans(docs, trained_detector(docs))
