"""Streaming queries, run to completion over what the tables hold."""

from __future__ import annotations

from shelfmark.plans import fixtures as fx
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources.store import open_store, stored_files
from shelfmark.streaming.copying import incremental_copy as copy_new
from shelfmark.streaming.grant_log import follow_grants, followed_grants


@query(
    """
    select '/store/home/raw/' || parse_filename(filename) as path, size, md5(content) as md5
    from read_blob('/root/testdata/sf0.01/*')
    """
)
def incremental_copy(spark, sf_dir):
    store, checkpoint = scratch_path(spark, "store"), scratch_path(spark, "copy")
    copy_new(spark, sf_dir, store, "/store/home/raw", checkpoint)
    copy_new(spark, sf_dir, store, "/store/home/raw", checkpoint)
    return stored_files(open_store(spark, store)).select("path", "size", "md5")


@query("select * from in_force", views=("in_force",))
def streaming_grants(spark, sf_dir):
    state, checkpoint = scratch_path(spark, "grants"), scratch_path(spark, "grant-log")
    schema = fx.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    follow_grants(fx.change_log(events), state, checkpoint)
    return followed_grants(spark, state)


@query("select * from in_force", views=("in_force",))
def streaming_grants_merged(spark, sf_dir):
    """The same log in twelve files, one a batch, with runs merged by fours."""
    source, state, checkpoint = (scratch_path(spark, name) for name in ("log", "grants", "grant-log"))
    events = fx.table(spark, sf_dir, "events")
    events.repartition(12, "event_id").write.parquet(source)
    log = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    follow_grants(fx.change_log(log), state, checkpoint, fan=4)
    return followed_grants(spark, state)
