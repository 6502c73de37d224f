"""Ranged export, sliced listings, arrivals and the log-structured grant state."""

import os
import time

import pyarrow.parquet as pq
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from shelfmark.functions.patterns import FileRules
from shelfmark.operators.grants import current_grants
from shelfmark.plans import fixtures as fx
from shelfmark.sources import files as tree
from shelfmark.sources import ranged_writer
from shelfmark.sources import store as content
from shelfmark.sources.ranged_writer import IncompleteFile, write_ranges
from shelfmark.streaming import grant_log
from shelfmark.streaming.copying import arrivals, incremental_copy
from tests.conftest import plan_of, rows
from tests.test_files_and_streams import contents

SF = "/root/testdata/sf0.001"
RANGES = "name string, offset long, content binary, last boolean"


def ranges(name, data, length):
    starts = range(0, max(len(data), 1), length)
    return [(name, at, data[at : at + length], at + length >= len(data)) for at in starts]


def test_ranges_in_any_order_make_whole_files(spark, tmp_path):
    wanted = {"a.bin": os.urandom(10_000), "empty": b"", "one": b"x", "even": b"y" * 2000}
    parts = [r for name, data in wanted.items() for r in ranges(name, data, 1000)]
    done = write_ranges(spark.createDataFrame(parts[::-1], RANGES).repartition(7), str(tmp_path / "out"))
    assert contents(str(tmp_path / "out")) == wanted
    assert rows(done, "name", "size", "ranges", "published") == sorted(
        (name, len(data), len(ranges(name, data, 1000)), True) for name, data in wanted.items()
    )


def test_a_taken_name_is_passed_over(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"mine")
    df = spark.createDataFrame(ranges("a", b"theirs", 2) + ranges("b", b"new", 9), RANGES)
    assert rows(write_ranges(df, str(tmp_path)), "name", "published") == [("a", False), ("b", True)]
    assert contents(str(tmp_path)) == {"a": b"mine", "b": b"new"}
    assert rows(write_ranges(df, str(tmp_path), overwrite=True), "published") == [(True,), (True,)]
    assert contents(str(tmp_path)) == {"a": b"theirs", "b": b"new"}


@pytest.mark.parametrize("spoil", ["gap", "end", "twice", "two ends", "start"])
def test_ranges_that_do_not_fit_leave_nothing(spark, tmp_path, spoil):
    parts = ranges("bad", b"0123456789", 4)
    parts = {
        "gap": [parts[0], parts[2]],
        "end": parts[:2],
        "twice": [*parts, parts[1]],
        "two ends": [*parts[:2], ("bad", 8, b"", True), parts[2]],
        "start": parts[1:],
    }[spoil]
    with pytest.raises(IncompleteFile, match="bad"):
        write_ranges(spark.createDataFrame(parts + ranges("good", b"fine", 9), RANGES), str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == []


def test_a_failing_task_leaves_nothing_visible(spark, tmp_path):
    good = spark.createDataFrame([r for k in range(20) for r in ranges(f"f{k}", b"0123456789", 4)], RANGES).repartition(4)
    boom = F.when(F.col("name") == "f7", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("content"))
    with pytest.raises(Exception, match="lost"):
        write_ranges(good.withColumn("content", boom), str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == []


def test_pieces_are_joined_where_files_have_no_ranges(tmp_path):
    local, staging = fs.LocalFileSystem(), tmp_path / "staging"
    staging.mkdir()
    pieces = []
    for k, data in enumerate((b"one,", b"two,", b"three")):
        (staging / f"p{k}").write_bytes(data)
        pieces.append(str(staging / f"p{k}"))
    target = str(tmp_path / "joined")
    publish = lambda overwrite=False: ranged_writer._publish(local, pieces, target, str(staging), overwrite)
    assert publish()
    assert open(target, "rb").read() == b"one,two,three"
    assert publish()  # the attempt is repeated after its move
    os.remove(pieces[0])
    assert publish()


def test_a_large_file_is_written_by_several_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    data = os.urandom(10_000)
    (tmp_path / "in" / "big").write_bytes(data)
    store = str(tmp_path / "store")
    content.append_new(tree.list_local_files(spark, str(tmp_path / "in")), store, "/h", chunk_bytes=1000)
    parts = content.ranges_of(content.open_store(spark, store))
    used = parts.select(F.spark_partition_id().alias("task")).distinct().count()
    assert parts.count() == 10 and used > 1
    content.export_directory(spark, store, "/h", str(tmp_path / "out"))
    assert contents(str(tmp_path / "out")) == {"big": data}


def test_a_repeat_hands_over_only_what_is_new(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for k in range(30):
        (tmp_path / "in" / f"f{k}").write_bytes(bytes([k]) * 2000)
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    content.ingest_directory(spark, str(tmp_path / "in"), store, "/h")
    content.export_directory(spark, store, "/h", out, FileRules(exclude_names=["f11"]))
    handed = []

    def counted(df, directory, overwrite=False):
        handed.append((df.count(), plan_of(df)))
        return write_ranges(df, directory, overwrite)

    monkeypatch.setattr(content, "write_ranges", counted)
    assert content.export_directory(spark, store, "/h", out) == (1, 29)
    assert handed[0][0] == 1
    assert "EqualTo(label,f11)" in handed[0][1]  # reaches the scan
    assert contents(out) == contents(str(tmp_path / "in"))
    monkeypatch.setattr(content, "PUSHED_NAMES", 0)
    os.remove(f"{out}/f3")
    assert content.export_directory(spark, store, "/h", out) == (1, 29)
    assert handed[1][0] == 1 and contents(out) == contents(str(tmp_path / "in"))


def test_a_file_that_grew_after_its_listing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "grown").write_bytes(b"z" * 5500)
    listed = tree.list_local_files(spark, str(tmp_path / "in")).withColumn("size", F.lit(10).cast("long"))
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    content.append_new(listed, store, "/h", chunk_bytes=1000)
    stored = content.open_store(spark, store)
    assert stored.count() == 6 and max(len(r.content) for r in stored.collect()) == 1000
    assert rows(content.stored_files(stored), "label", "size") == [("grown", 5500)]
    content.export_directory(spark, store, "/h", out)
    assert contents(out) == {"grown": b"z" * 5500}


def test_a_task_is_handed_little_of_a_large_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "big", "wb") as out:
        out.truncate(128 << 20)
    store = str(tmp_path / "store")
    content.append_new(tree.list_local_files(spark, str(tmp_path / "in")), store, "/h", chunk_bytes=1 << 20)
    parts = content.ranges_of(content.open_store(spark, store)).select(F.spark_partition_id().alias("task"), "offset")
    heaviest = parts.groupBy("task").count().agg(F.max("count")).first()[0]
    assert parts.count() == 128 and heaviest <= 24  # rows of 1 MB


def stored_parts(store):
    found = [os.path.join(d, n) for d, _, names in os.walk(store) for n in names if n.endswith(".parquet")]
    return [pq.ParquetFile(n).metadata for n in found]


def test_a_row_group_holds_few_chunks_and_no_content_statistics(spark, tmp_path):
    (tmp_path / "in").mkdir()
    data = os.urandom(1 << 20) * 40
    (tmp_path / "in" / "big").write_bytes(data)
    (tmp_path / "in" / "small").write_bytes(b"small")
    store = str(tmp_path / "store")
    content.append_new(tree.list_local_files(spark, str(tmp_path / "in")), store, "/h", chunk_bytes=1 << 20)
    groups = [m.row_group(k) for m in stored_parts(store) for k in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 41 and max(g.num_rows for g in groups) <= 16
    columns = [g.column(k) for g in groups for k in range(g.num_columns)]
    assert not any(c.is_stats_set for c in columns if c.path_in_schema == "content")
    assert all(c.is_stats_set for c in columns if c.path_in_schema == "label")
    content.export_directory(spark, store, "/h", str(tmp_path / "out"))
    assert contents(str(tmp_path / "out")) == {"big": data, "small": b"small"}


def test_a_row_group_holds_few_files_that_compress_well(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(120):
        with open(tmp_path / "in" / f"f{k}", "wb") as out:
            out.truncate(1 << 20)
    store = str(tmp_path / "store")
    assert content.ingest_directory(spark, str(tmp_path / "in"), store, "/h") == (120, 0)
    groups = [m.row_group(k).num_rows for m in stored_parts(store) for k in range(m.num_row_groups)]
    assert sum(groups) == 120 and max(groups) <= 16


def test_large_files_are_spread_by_bytes(spark):
    sizes = [("a", 900), ("b", 1000), ("c", 950), *[(f"s{k}", 1) for k in range(40)]]
    df = spark.createDataFrame([(n, s) for n, s in sizes], "label string, size long").coalesce(1)
    spread = tree.spread_by_bytes(df, task_bytes=1000).withColumn("task", F.spark_partition_id())
    heavy = spread.groupBy("task").agg(F.sum("size").alias("bytes"), F.count_if(F.col("size") > 500).alias("large"))
    assert spread.count() == 43
    assert max(r.large for r in heavy.collect()) == 1


def test_a_folder_is_listed_by_several_tasks(spark, tmp_path):
    for k in range(3000):
        (tmp_path / f"name-{k}").touch()
    (tmp_path / "sub").mkdir()
    listed = tree.list_local_files(spark, str(tmp_path), slice_bytes=1 << 12)
    assert listed.rdd.getNumPartitions() > 1
    assert listed.count() == 3000 and listed.select("label").distinct().count() == 3000
    assert listed.select(F.spark_partition_id()).distinct().count() > 1


def test_a_sliced_listing_reads_each_name_once(spark, tmp_path):
    wanted = {f"name-{k}": k % 3 for k in range(3000)} | {".hidden": 1, "_under": 2, "sp ace%23#": 0}
    for name, size in wanted.items():
        (tmp_path / name).write_bytes(b"x" * size)
    (tmp_path / "sub").mkdir()
    os.mkdir(os.fsencode(tmp_path) + b"/no\xfftext")
    (tmp_path / "gone").symlink_to(tmp_path / "nowhere")
    (tmp_path / "link").symlink_to(tmp_path / "_under")
    listed = tree.list_local_files(spark, str(tmp_path), slice_bytes=64)
    cores = spark.sparkContext.defaultParallelism
    # Each task would read all names, or else what one has read is dealt to the others.
    assert 1 < listed.rdd.getNumPartitions() <= 4 * cores
    assert "Range (0, 1, step=1, splits=1)" in plan_of(listed)
    assert rows(listed, "label", "size") == sorted({**wanted, "link": 2}.items(), key=repr)


def test_arrivals_show_every_kind_of_file_once(spark, tmp_path):
    source, seen, checkpoint = tmp_path / "in", str(tmp_path / "seen"), str(tmp_path / "checkpoint")
    (source / "sub").mkdir(parents=True)
    for name in ("plain", ".hidden", "_under", "sub/deep"):
        (source / name).write_text(name)
    (source / "empty").touch()

    def run():
        stream = arrivals(spark, str(source), overlap=0)
        query = stream.writeStream.format("parquet").option("path", seen).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
        return rows(spark.read.parquet(seen), "label")

    first = [(".hidden",), ("_under",), ("empty",), ("plain",)]
    assert run() == first
    (tmp_path / "moved").write_text("with an old time")
    os.utime(tmp_path / "moved", (1, 1))
    time.sleep(0.1)
    os.rename(tmp_path / "moved", source / "moved")
    assert run() == sorted([*first, ("moved",)])


def test_incremental_copy_skips_what_is_shown_again(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    for k in range(5):
        (source / f"f{k}").write_text(str(k))
        incremental_copy(spark, str(source), store, "/h", str(tmp_path / "checkpoint"), FileRules(exclude_names=["f2"]))
    assert rows(content.open_store(spark, store), "label") == [("f0",), ("f1",), ("f3",), ("f4",)]


@pytest.fixture
def log(spark, tmp_path):
    """Changes in fifty files, one a batch, and the grants they leave."""
    events = fx.table(spark, SF, "events").repartition(50, "event_id")
    events.write.parquet(str(tmp_path / "log"))
    return str(tmp_path / "log"), rows(current_grants(fx.change_log(events)))


def follow(spark, source, state, checkpoint, fan):
    schema = fx.table(spark, SF, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    grant_log.follow_grants(fx.change_log(stream), state, checkpoint, fan)


def test_many_batches_leave_a_bounded_number_of_runs(spark, tmp_path, log):
    source, wanted = log
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    follow(spark, source, state, checkpoint, 4)
    live, stale = grant_log.runs(spark, state)
    assert len(live) <= 3 * 3 and [a for a, _ in live] == [0, *[b + 1 for _, b in live[:-1]]] and live[-1][1] == 49
    assert len(os.listdir(state)) == len(live) + len(stale) <= 3 * 3 + 4
    assert rows(grant_log.followed_grants(spark, state)) == wanted


def test_replayed_and_broken_runs_change_nothing(spark, tmp_path, log):
    source, wanted = log
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    follow(spark, source, state, checkpoint, 8)
    assert (48, 48) in grant_log.runs(spark, state)[0]
    # A merge that was killed left a folder without its mark.
    os.makedirs(f"{state}/run-0-49")
    assert rows(grant_log.followed_grants(spark, state)) == wanted
    # The last two commits are lost, so their batches come again.
    for batch in (48, 49):
        for name in (f"{batch}", f".{batch}.crc"):
            if os.path.exists(f"{checkpoint}/commits/{name}"):
                os.remove(f"{checkpoint}/commits/{name}")
    follow(spark, source, state, checkpoint, 8)
    assert rows(grant_log.followed_grants(spark, state)) == wanted


def test_no_state_no_grants(spark, tmp_path):
    assert rows(grant_log.followed_grants(spark, str(tmp_path / "none"))) == []
