"""Merkle manifest, line dedup and lexical search against plain Python versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import lexical_search, line_dedup, merkle
from tests.conftest import plan_of
from tests.llm.helpers import clashing, documents

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha(*[field(v) for v in (doc_id, source, lang, n_chars, text)])


def build(nodes):
    """The root of a list of digests, and the siblings of each leaf as (before, after)."""
    paths = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        merged, kids = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for leaf in under[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            merged.append(sha(*run))
            kids.append([leaf for k in range(at, at + len(run)) for leaf in under[k]])
        nodes, under = merged, kids
    return nodes[0], paths


def brute_manifest(rows):
    """What op11 gives for (doc_id, text, lang, source, n_chars) rows."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0], leaf_of(*row), row))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    subroots = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subroots[name] = build([leaf for _, leaf, _ in trees[name]])
    if not names:
        return []
    root, above = build([subroots[name][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for (doc_id, leaf, row), path in zip(trees[name], subroots[name][1]):
            path = path + above[at]
            node = leaf
            if doc_id is not None and row[1] is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                node = leaf_of(row[0], row[1].translate(UPPER), *row[2:])
            for before, after in path:
                node = sha(before, node, after)
            proof = sha(*[before + after for before, after in path])
            out.append((doc_id, leaf, subroots[name][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def manifest(spark, df, tmp_path_factory):
    """The registered query over a table of a test."""
    folder = str(tmp_path_factory.mktemp("sf"))
    df.write.parquet(f"{folder}/documents.parquet")
    got = merkle.op11_merkle_manifest(spark, folder)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == names
    return sorted((tuple(r) for r in got.collect()), key=repr)


SHAPES = {
    "one": [(5, "Only Text", "en", "s", 9)],
    "empty": [],
    "lone leaves and nulls": [(1, "A", None, None, None), (2, None, "de", "s", 0), (None, "B c", "fr", "s", 3), (9, "", "", "s", 0)],
    "sixty-five in one tree": [(k, f"Text {k}", "en", f"s{k % 3}", k) for k in range(65)],
    "ten trees": [(k, f"T {k}", f"l{k % 10}", "s", k) for k in range(85)],
    "repeated rows and ids": [(k % 4, f"Same {k % 2}", "en", "s", 1) for k in range(40)],
    "a long text": [(3, "Long " * 200_000, "en", "s", 1), (12, "x", "en", "s", 1)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_manifest_equals_a_plain_one(spark, tmp_path_factory, shape):
    rows = SHAPES[shape]
    df = documents(spark, *rows).repartition(3)
    assert manifest(spark, clashing(df), tmp_path_factory) == brute_manifest(rows)


def test_other_fans(spark):
    leaves = spark.range(11).select(
        F.lit("t").alias("tree"), F.col("id").alias("index"), F.lit(11).cast("long").alias("nodes"), F.sha2(F.col("id").cast("string"), 256).alias("digest")
    )
    found = merkle.levels(leaves, fan=2)
    assert [level.count() for level in found] == [11, 6, 3, 2, 1]
    top = merkle.roots(found).select("tree", F.array().cast(merkle._PATH).alias("path"), F.col("digest").alias("root"))
    proven = merkle.with_paths(found, top, fan=2).select("root", merkle.folded(F.col("digest")).alias("again"))
    assert proven.filter("root = again").count() == 11


def brute_lines(rows, least=10):
    keyed, first, holders = [], {}, {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\n\x0b\x0c\r").translate(UPPER) for line in lines]
        keyed.append((doc_id, lines, keys))
        for key in keys:
            if len(key) >= least and doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
                holders.setdefault(key, set()).add(doc_id)
    out = []
    for doc_id, lines, keys in keyed:
        gone = [doc_id is not None and len(holders.get(k, ())) > 1 and doc_id != first[k] for k in keys]
        kept = [line for line, g in zip(lines, gone) if not g]
        out.append((doc_id, len(lines), sum(gone), sha("\n".join(kept))))
    return sorted(out, key=repr)


LICENSE = "This line stands in many documents"
LINES = [
    (7, f"first here\n{LICENSE}\n\n{LICENSE.upper()}\nlast one"),
    (3, f"  {LICENSE}\t\nshort\nshort\n{LICENSE}"),
    (9, f"{LICENSE}"),
    (4, None),
    (5, ""),
    (6, "\n\n"),
    (None, f"{LICENSE}\nnot numbered"),
    (8, "ÄÖÜ äöü ÄÖÜ\nÉcole normale"),
    (2, "äöü äöü ÄÖÜ\nÉCOLE NORMALE"),
    (1, "äÖÜ"),
    (11, f"a\n{LICENSE}\nb\r\nshort line\x0b\nc"),
    (12, "short line \n" * 3 + "tab\tin it   "),
    (12, "tab\tin it   \nother text of one id"),
    (9, f"{LICENSE}"),
    (10, "word " * 100_000 + "\n" + LICENSE),
]


def lines_of(df):
    out = line_dedup.keep_bitmaps(df)
    kept = line_dedup.kept_text(F.col("in_text"), F.col("keep"))
    staying = F.aggregate("keep", F.lit(0), lambda n, r: n + r["length"])
    picked = out.select("in_doc_id", F.col("n_lines"), F.col("n_lines") - staying, F.sha2(kept, 256))
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def test_lines_equal_a_plain_version(spark):
    df = documents(spark, *LINES).repartition(4)
    assert lines_of(clashing(df)) == brute_lines(LINES)


def test_lines_of_many_documents_with_a_common_line(spark):
    rows = [(k, f"{LICENSE}\nown line number {k}\nshared by some {k % 7}\n{LICENSE}") for k in range(600)]
    assert lines_of(documents(spark, *rows).repartition(5)) == brute_lines(rows)


def test_lines_of_an_empty_table(spark):
    assert lines_of(documents(spark)) == []


def test_bitmaps_are_runs_and_no_python_runs(spark):
    rows = [(1, "\n".join(f"line number {k}" for k in range(50))), (2, "own\n" + "\n".join(f"line number {k}" for k in range(50)) + "\nend")]
    out = line_dedup.keep_bitmaps(documents(spark, *rows))
    keep = {r.in_doc_id: [(x.start, x.length) for x in r.keep] for r in out.collect()}
    assert keep == {1: [(0, 50)], 2: [(0, 1), (51, 1)]}
    assert not re.search("Python|Arrow|Pandas", plan_of(out))


def test_streaming_needs_one_exchange_a_pass(spark):
    rows = line_dedup.line_hashes(documents(spark, *LINES))
    plan = line_dedup._streamed(rows, "h1", "h2")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange (?:range|hash)partitioning", plan)) == 1


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute_search(docs, items, top=10):
    held = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    count = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms_of(text))
    out = []
    for item_id, terms in wanted.items():
        found = []
        for doc_id, c in held:
            m = 10 + (90 * sum(c.values()) * count) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top]):
            out.append((item_id, rank + 1, doc_id, -score))
    return sorted(out, key=repr)


DOCS = [(k, " ".join(f"w{(k * j) % 37}" for j in range(k % 23)) + ("Über café, naïve" if k % 5 == 0 else "")) for k in range(120)] + [
    (200, None),
    (201, ""),
    (202, ".,;! --"),
    (None, "w1 w2 w3 w4"),
    (204, "x" * 300_000 + " W1-w1_w2\x00w3"),
    (50, "w7 w7"),
    (51, "w7 w7"),
    (51, "w7 w7"),
]
ITEMS = [(1, "w1 W2, w3!"), (2, "über; nothing"), (3, "missing words"), (4, ""), (5, None), (6, "w7"), (6, "w9"), (None, "café w1 w1"), (8, "w1w2")]


def searched(spark, docs, items, **more):
    df = documents(spark, *docs).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit(1))
    return sorted((tuple(r) for r in lexical_search.search(clashing(df), asked, **more).collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 8])
def test_search_equals_a_plain_version(spark, block_bytes):
    assert searched(spark, DOCS, ITEMS, block_bytes=block_bytes) == brute_search(DOCS, ITEMS)


def test_search_in_small_tables_of_sums(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "_CELLS", 4)
    assert searched(spark, DOCS, ITEMS, top=3) == brute_search(DOCS, ITEMS, top=3)


def test_guards_of_a_slice_of_texts():
    texts = ["é" * (k % 30) + " ,X " + "ñ." * (k % 5) for k in range(900)]
    whole = lexical_search.guarded(pa.array(texts))
    assert lexical_search.guarded(pa.array(texts).slice(300, 400)).equals(whole.slice(300, 400))


def test_many_equal_documents_tie_by_id(spark):
    docs = [(k, "same words here") for k in range(300, 0, -1)]
    assert searched(spark, docs, [(1, "same here"), (2, "words")]) == brute_search(docs, [(1, "same here"), (2, "words")])


def test_search_in_empty_tables(spark):
    assert searched(spark, [], ITEMS) == []
    assert searched(spark, DOCS, []) == []
