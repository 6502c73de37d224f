import hashlib
import os
import time
from types import SimpleNamespace

import pytest

from shelfmark.functions.patterns import FileRules
from shelfmark.operators import listing
from shelfmark.operators.grants import current_grants
from shelfmark.plans import fixtures as fx
from shelfmark.session import scratch_path
from shelfmark.sources import catalog
from shelfmark.sources import files as tree
from shelfmark.sources import store as content
from shelfmark.streaming.copying import incremental_copy
from shelfmark.streaming.grant_log import follow_grants, followed_grants
from tests.conftest import plan_of, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "source"
    (source / "sub").mkdir(parents=True)
    (source / "f1.txt").write_text("Hello, 1!")
    (source / "f2.txt").write_text("Hello, 2!")
    (source / "big.bin").write_bytes(os.urandom(100_000))
    (source / "edge.bin").write_bytes(b"x" * 4096)
    (source / "empty.txt").write_text("")
    (source / ".hidden").write_text("dot")
    (source / "_under.txt").write_text("underscore")
    (source / "k=1").mkdir()
    (source / "k=1" / "part.txt").write_text("not listed")
    (source / "sub" / "deep.txt").write_text("not listed")
    return str(source)


def contents(folder):
    names = [n for n in os.listdir(folder) if os.path.isfile(os.path.join(folder, n))]
    return {n: open(os.path.join(folder, n), "rb").read() for n in names}


def digests(folder):
    return sorted((n, len(b), hashlib.md5(b).hexdigest()) for n, b in contents(folder).items())


def test_listing_is_not_recursive_and_opens_no_file(spark, folder):
    listed = tree.list_local_files(spark, folder)
    assert {r[0] for r in rows(listed, "label")} == set(contents(folder))
    picked = tree.list_local_files(spark, folder, FileRules(["/F1", "big"], exclude_names=["big.bin"]))
    assert rows(picked, "label") == [("f1.txt",)]


def test_digests(spark, folder):
    got = tree.file_digests(tree.list_local_files(spark, folder))
    assert rows(got, "label", "size", "md5") == digests(folder)


@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}/"])
def test_plain_paths_and_uris(spark, folder, form):
    got = tree.list_local_files(spark, form.format(folder))
    assert rows(got, "path") == sorted((f"{folder}/{n}",) for n in contents(folder))
    assert rows(tree.file_digests(got), "label", "size", "md5") == digests(folder)


def test_missing_source(spark, folder):
    with pytest.raises(FileNotFoundError):
        tree.list_local_files(spark, folder + "/nope")


@pytest.mark.parametrize("chunk_bytes", [1000, 4096, 10**6])
def test_chunks_put_together_are_the_file(spark, folder, chunk_bytes):
    got = {}
    for row in tree.read_chunks(tree.list_local_files(spark, folder), chunk_bytes).orderBy("label", "part").collect():
        assert len(row.content) <= chunk_bytes
        got.setdefault(row.label, []).append((row.part, bytes(row.content), row.md5))
    for name, data in contents(folder).items():
        assert [p for p, _, _ in got[name]] == list(range(len(got[name])))
        assert b"".join(c for _, c, _ in got[name]) == data
        assert [m for _, _, m in got[name]] == [None] * (len(got[name]) - 1) + [hashlib.md5(data).hexdigest()]


def test_copy_in_and_out(spark, folder, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    content.append_new(tree.list_local_files(spark, folder), store, "/store/home/me", chunk_bytes=1000)
    catalog = content.stored_files(content.open_store(spark, store))
    assert rows(catalog, "label", "size", "md5") == digests(folder)
    stored = content.open_store(spark, store)
    assert {r[0] for r in rows(stored.filter("chunked"), "label")} == {"big.bin", "edge.bin"}
    assert "content" not in plan_of(catalog).split("ReadSchema")[1]
    content.export_directory(spark, store, "/store/home/me/", out)
    assert contents(out) == contents(folder)


def test_a_repeated_copy_moves_nothing(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    for _ in range(2):
        content.ingest_directory(spark, folder, store, "/store/home/me")
    assert content.open_store(spark, store).count() == 7
    content.ingest_directory(spark, folder + "/f1.txt", store, "/store/home/other/")
    assert content.open_store(spark, store).filter("parent = '/store/home/other'").count() == 1
    with pytest.raises(FileNotFoundError):
        content.ingest_directory(spark, folder + "/nope", store, "/store/home/me")


def test_stored_name_wins_over_a_later_source(spark, folder, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    content.ingest_directory(spark, folder, store, "/h", FileRules(include_names=["f1.txt"]))
    with open(folder + "/f1.txt", "w") as file:
        file.write("changed")
    content.ingest_directory(spark, folder, store, "/h")
    content.export_directory(spark, store, "/h", out)
    assert contents(out)["f1.txt"] == b"Hello, 1!"


def test_overwrite_is_honoured(spark, folder, tmp_path):
    store, out = str(tmp_path / "store"), tmp_path / "out"
    out.mkdir()
    (out / "f1.txt").write_text("mine")
    content.ingest_directory(spark, folder, store, "/h")
    content.export_directory(spark, store, "/h", str(out), FileRules(["/F1", "/f2"]))
    assert contents(out) == {"f1.txt": b"mine", "f2.txt": b"Hello, 2!"}
    content.export_directory(spark, store, "/h", str(out), overwrite=True)
    assert contents(out) == contents(folder)


def test_nothing_is_copied_when_the_manifest_differs(spark, folder, tmp_path, frame):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    content.ingest_directory(spark, folder, store, "/h")
    good = frame("name string, checksum string", *[(n, d) for n, _, d in digests(folder)])
    with pytest.raises(ValueError, match="manifest"):
        content.export_directory(spark, store, "/h", out, manifest=good.filter("name <> 'f1.txt'"))
    assert not os.path.exists(out)
    content.export_directory(spark, store, "/h", out, manifest=good)
    assert contents(out) == contents(folder)


def test_export_of_one_file_and_of_nothing(spark, folder, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    content.ingest_directory(spark, folder, store, "/h")
    content.export_directory(spark, store, "/h/f1.txt/", out, FileRules(["no such pattern"]))
    assert contents(out) == {"f1.txt": b"Hello, 1!"}
    with pytest.raises(FileNotFoundError, match="no such path"):
        content.export_directory(spark, store, "/nope", out)
    with pytest.raises(ValueError, match="nothing selected"):
        content.export_directory(spark, store, "/h", out, FileRules(["no such pattern"]))


def test_copies_report_and_a_repeat_reads_no_content(spark, folder, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    first = content.ingest_directory(spark, folder, store, "/h")
    assert content.ingest_directory(spark, folder, store, "/h") == (0, first.copied)
    assert content.export_directory(spark, store, "/h", out) == (first.copied, 0)
    before = {name: os.stat(f"{out}/{name}").st_mtime_ns for name in os.listdir(out)}
    assert content.export_directory(spark, store, "/h", out).copied == 0
    assert {name: os.stat(f"{out}/{name}").st_mtime_ns for name in os.listdir(out)} == before
    assert not [name for name in before if name.startswith(".writing")]


@pytest.mark.parametrize("name", ["a b.txt", "50%.txt", "x#y.txt", "q?.txt", "é&=.txt"])
def test_names_with_signs_round_trip(spark, tmp_path, name):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / name).write_text("here")
    content.ingest_directory(spark, f"file://{source}", str(tmp_path / "store"), "/h")
    content.export_directory(spark, str(tmp_path / "store"), "/h", out)
    assert contents(out) == {name: b"here"}


def test_a_stored_catalog_prunes_by_directory(spark, tmp_path):
    location = str(tmp_path / "catalog")
    objects = fx.objects(spark, SF)
    catalog.write_catalog(objects, location)
    stored = catalog.read_catalog(spark, location)
    assert rows(stored) == rows(objects)
    assert "EqualTo(parent,/store/home/src1)" in plan_of(listing.list_directory(stored, "/store/home/src1/"))


def test_incremental_copy_moves_only_what_is_new(spark, folder, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        incremental_copy(spark, folder, store, "/h", checkpoint)
        return content.open_store(spark, store).count()

    assert run() == 7
    with open(folder + "/f3.txt", "w") as file:
        file.write("Hello, 3!")
    assert run() == 8
    assert run() == 8
    # A file that arrives late with an old time is copied too.
    with open(folder + "/late.txt", "w") as file:
        file.write("late")
    month_ago = time.time() - 30 * 86400
    os.utime(folder + "/late.txt", (month_ago, month_ago))
    assert run() == 9


def test_followed_grants_equal_the_batch_fold(spark, tmp_path):
    events = fx.table(spark, SF, "events")
    source, state, checkpoint = (str(tmp_path / n) for n in ("events", "state", "checkpoint"))
    for low, high in ((0, 400), (400, 700), (700, 1000)):
        events.filter(f"event_id >= {low} and event_id < {high}").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        follow_grants(fx.change_log(stream), state, checkpoint)
        so_far = fx.change_log(events.filter(f"event_id < {high}"))
        assert rows(followed_grants(spark, state)) == rows(current_grants(so_far))
    assert len(os.listdir(state)) == 3


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "/shared/folder/"}.get(key, default))
    assert scratch_path(SimpleNamespace(conf=conf), "x").startswith("/shared/folder/x-")
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="spark://host:1")
    )
    with pytest.raises(RuntimeError):
        scratch_path(unset, "x")
