"""Both near-duplicate operators against brute force, and their edge cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import embedding_dedup, minhash_dedup
from shelfmark.llm.common import components, local_roots, sorted_groups
from tests.conftest import plan_of
from tests.llm.helpers import clashing, documents


def reach(nodes, links):
    """The smallest node each node reaches."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(100, 140)] + [(7, 500 + k) for k in range(60)] + [(3, 3)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    rng.shuffle(links)
    edges = spark.createDataFrame([*links, *links[:5], (None, 2)], "a long, b long")
    found = {r.node: r.component_id for r in components(edges).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: c for n, c in reach({n for e in links for n in e}, links).items() if n in linked}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_roots():
    roots = local_roots(6, np.array([5, 4, 1]), np.array([4, 2, 0]))
    assert roots.tolist() == [0, 0, 2, 3, 2, 2]


def brute_vectors(rows, threshold=0.98):
    ok = {}
    for vec_id, vector, label in rows:
        if vector and label is not None and vec_id is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector):
            ok[vec_id] = (np.array(vector, float) / np.linalg.norm(vector), label)
    links = [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= threshold]
    root = reach([r[0] for r in rows if r[0] is not None], links)
    degree = {n: sum(n in e for e in links) for n in root}
    return sorted((n, degree[n], root[n], root[n] == n) for n in root)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = []
    for center in range(12):
        base = rng.standard_normal(16)
        for k in range(1 + 40 * (center == 0) + center % 4):
            noise = rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in base + noise], center % 3))
    rows += [(len(rows) + k, rows[k][1], rows[k][2]) for k in range(3)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, rows[0][1], None)]
    return rows + [(905, [1.0, None], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [float("inf"), 1.0], 1)]


def test_vectors_equal_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)  # hot buckets take several blocks
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(clashing(df)).collect()))
    assert got == brute_vectors(vectors)


def test_vectors_with_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr)
    assert got == [(1, 1, 1, True)] * 3 + [(2, 1, 1, False), (None, 0, None, True)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def shingles(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in text.replace("\x1c", "?").replace("\x85", "?").split() if w] if text.isascii() else text.split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) or frozenset([tuple(words)])


def brute_documents(rows):
    sets = {d: shingles(t) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = reach(sets, links)
    return sorted((d, len(sets[d]), root[d], root[d] == d) for d in sets)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for group in range(14):
        base = [rng.choice(words) for _ in range(120)]
        if group % 2:
            base[:60] = passage  # a passage that many documents share
        for k in range(2 + 30 * (group == 0)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), "Only Three Words"), (len(rows) + 1, " only three\twords\n"), (len(rows) + 2, "only three")]
    return rows + [(800, None), (801, ""), (802, " \n "), (803, "lone"), (804, "x " * 5000), (805, "x " * 9)]


def test_documents_equal_brute_force(spark, texts, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    got = sorted(map(tuple, minhash_dedup.near_duplicates(clashing(documents(spark, *texts))).collect()))
    assert got == brute_documents(texts)


def test_documents_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "q r s t u v"), (9, "q r s t u v"), (9, "q r s t u v")]
    df = documents(spark, *rows)
    got = sorted(((r[0], r[2], r[3]) for r in minhash_dedup.near_duplicates(df).collect()), key=repr)
    assert got == [(4, 4, True)] * 2 + [(9, 4, False)] * 2 + [(None, None, True)]
    kept = minhash_dedup.distinct_documents(df)
    assert kept.columns == df.columns
    # Both texts of the fourth document stay, as they are different.
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [4, 4, None]
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    constants = minhash_dedup._constants(minhash_dedup.FINE_SAMPLES)
    for share in (0.6, 0.75, 0.9):
        both = int(800 * share)
        left = rng.integers(0, 1 << 63, 800).astype(np.uint64)
        right = np.concatenate([left[:both], rng.integers(0, 1 << 63, 800 - both).astype(np.uint64)])
        truth = both / (1600 - both)
        rows = np.array([minhash_dedup.min_hashes(x, *constants) for x in (left, right)])
        sketch = minhash_dedup.odd_sketches(rows, minhash_dedup.FINE_BITS)
        assert abs(minhash_dedup.estimated_similarity(sketch[:1], sketch[1:], minhash_dedup.FINE_SAMPLES)[0, 0] - truth) < 0.06


def test_links_of_two_texts_under_one_id(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(40)]
    near = [t + " one two" for t in texts]
    rows = [(k // 2, t) for k, t in enumerate(texts)] + [(100 + k, t) for k, t in enumerate(near)]
    df = documents(spark, *rows)
    got = {(r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(df).collect()}
    assert got == {(k // 2, k // 2) for k in range(40)} | {(100 + k, k // 2) for k in range(40)}
    # Different texts of one id are documents of their own, and stay.
    kept = minhash_dedup.distinct_documents(df)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(rows[:40])


def test_blocks_confirm_and_hand_on_a_forest(spark, monkeypatch):
    draw = random.Random(9)
    passage = " ".join(draw.choices("abcdefghij", k=120))
    rows = [(k, passage + " " + " ".join(draw.choices("klmnopqrstuvwxyz", k=draw.choice([10, 30, 45, 60])))) for k in range(120)]
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    wanted = sorted((k, len(sets[k]), find(k), find(k) == k) for k in sets)
    df = documents(spark, *rows)
    assert sorted(map(tuple, minhash_dedup.near_duplicates(df).collect())) == wanted
    # No set is carried along, and all pairs are confirmed by joins.
    monkeypatch.setattr(minhash_dedup, "LARGE", 0)
    assert sorted(map(tuple, minhash_dedup.near_duplicates(df).collect())) == wanted


def test_a_forest_has_fewer_links_than_components():
    sets = [np.arange(k % 2, 100, dtype=np.uint64) for k in range(20)]
    left, right = np.nonzero(~np.eye(20, dtype=bool))
    sizes = np.array([len(s) for s in sets])
    links, unsure = minhash_dedup._forest(left, right, np.arange(20), sizes, np.ones(20, bool), lambda k: sets[k].tobytes(), 75)
    assert len(links) == 19 and not unsure


def test_short_buckets_are_worked_on_together(spark, monkeypatch):
    rng = np.random.default_rng(13)
    rows = []
    for k in range(900):
        base = rng.standard_normal(8 + 4 * (k % 3 == 0))
        near = [base, base + 0.01 * rng.standard_normal(len(base)), base][: 1 + k % 3]
        rows += [(len(rows) + n, [float(np.float32(x)) for x in v], k % 2 or None if k % 50 == 0 else k % 2) for n, v in enumerate(near)]
    rows += [(len(rows) + k, None, 1) for k in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    local_roots, products = embedding_dedup.local_roots, spark.sparkContext.accumulator(0)

    def noted(*args):
        products.add(1)
        return local_roots(*args)

    monkeypatch.setattr(embedding_dedup, "local_roots", noted)
    wanted = brute_vectors(rows)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect())) == wanted
    # Some 600 pairs meet in most of the tables: not each bucket is a step of its own.
    assert 0 < products.value < 600
    monkeypatch.setattr(embedding_dedup, "TOGETHER", 1)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect())) == wanted
    monkeypatch.setattr(embedding_dedup, "TOGETHER", 7)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 2)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect())) == wanted


def test_groups_come_together_whole():
    rng = np.random.default_rng(3)
    k = np.sort(rng.integers(0, 300, 2000))
    table = pa.table({"k": k, "n": np.arange(2000)})
    for least in (1, 2, 50, 5000):
        for size in (1, 7, 400, 2000):
            runs = list(sorted_groups(iter(table.to_batches(max_chunksize=size)), ["k"], least))
            assert pa.concat_tables(runs).equals(table)
            ends = [(r["k"][0].as_py(), r["k"][-1].as_py()) for r in runs]
            assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
            assert least > 1 or all(a == b for a, b in ends)
            assert size < 2000 or all(r.num_rows >= least for r in runs[:-1])


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_only_copies_are_looked_up_by_vector(spark, threshold):
    rng = np.random.default_rng(14)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(6)], k % 2) for k in range(60)]
    rows += [(100 + k, rows[k % 5][1], k % 2) for k in range(40)] + [(200, [-0.0, 1.0], 0), (201, [0.0, 1.0], 0), (202, None, 0)]
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
        assert not [x for x in plan_of(found).splitlines() if "Join" in x and "label" in x]
        assert sorted(map(tuple, found.collect())) == brute_vectors(rows)
        # One id for a vector that is there once and for one that has copies, and none for another.
        odd = [(1, rows[0][1], 0), (1, rows[7][1], 0), (2, rows[7][1], 0), (3, rows[7][1], 0), (None, rows[7][1], 0)]
        found = embedding_dedup.near_duplicates(spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int"))
        got = sorted(map(tuple, found.collect()), key=repr)
        assert got == [(1, 2, 1, True)] * 2 + [(2, 2, 1, False), (3, 2, 1, False), (None, 0, None, True)]
    finally:
        spark.conf.set(name, before)
