"""Checksum, transfer-plan and copy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.patterns import FileRules
from shelfmark.operators import integrity, listing, lookup, selection, transfer
from shelfmark.plans import fixtures as fx
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources import files as tree
from shelfmark.sources import store as content
from shelfmark.sources.ranged_writer import write_ranges

_VERIFY = """
    select coalesce(a.label, e.name) as name, a.md5 as actual, e.checksum as expected,
           case when coalesce(a.n, 0) > 1 or coalesce(e.n, 0) > 1 then 'duplicate'
                when e.name is null then 'unexpected'
                when a.label is null then 'missing'
                when a.md5 = e.checksum then 'ok' else 'mismatch' end as status
    from (select label, max(md5) as md5, count(*) as n from objects where type = 'file' group by label) a
    full join (select name, max(checksum) as checksum, count(*) as n from manifest group by name) e
      on a.label = e.name
"""


def _files(spark, sf_dir):
    return listing.of_type(fx.objects(spark, sf_dir), "file")


@query(_VERIFY, views=("objects", "manifest"))
def verify_checksums(spark, sf_dir):
    return integrity.verify_checksums(_files(spark, sf_dir), fx.manifest(spark, sf_dir))


@query(
    f"""
    select count(*) filter (status = 'ok') as n_ok, count(*) filter (status = 'mismatch') as n_mismatch,
           count(*) filter (status = 'unexpected') as n_unexpected, count(*) filter (status = 'missing') as n_missing,
           count(*) filter (status = 'duplicate') as n_duplicate, count(*) filter (status <> 'ok') = 0 as passed
    from ({_VERIFY})
    """,
    views=("objects", "manifest"),
)
def checksum_summary(spark, sf_dir):
    return integrity.checksum_summary(verify_checksums(spark, sf_dir))


def _labelled(spark, sf_dir):
    """Names already at the target: the documents that have a label."""
    return fx.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("label")
    )


_TAKEN = "label in (select 'doc_' || doc_id || '.txt' from labels)"


@query(
    f"select path, label, case when {_TAKEN} then 'skip' else 'copy' end as action from objects where type = 'file'",
    views=("objects",),
)
def skip_existing(spark, sf_dir):
    plan = transfer.plan_actions(_files(spark, sf_dir), _labelled(spark, sf_dir))
    return plan.select("path", "label", "action")


@query(
    f"select path, label, case when {_TAKEN} then 'overwrite' else 'copy' end as action from objects where type = 'file'",
    views=("objects",),
)
def overwrite_existing(spark, sf_dir):
    plan = transfer.plan_actions(_files(spark, sf_dir), _labelled(spark, sf_dir), overwrite=True)
    return plan.select("path", "label", "action")


@query(
    f"select path, label from objects where type = 'file' and not ({_TAKEN})", views=("objects",)
)
def copy_candidates(spark, sf_dir):
    fresh = transfer.skip_existing(_files(spark, sf_dir), _labelled(spark, sf_dir))
    return fresh.select("path", "label")


@query(
    """
    select parent, path, row_number() over (partition by parent order by path) - 1 as ordinal
    from objects where type = 'file'
    """,
    views=("objects",),
)
def transfer_ordinal(spark, sf_dir):
    files = _files(spark, sf_dir).select("parent", "path")
    return transfer.transfer_ordinals(files)


# The same numbering with groups split into slices, as a hot directory would be.
@query(
    """
    select parent, path, row_number() over (partition by parent order by path) - 1 as ordinal
    from objects where type = 'file'
    """,
    views=("objects",),
)
def transfer_ordinal_sliced(spark, sf_dir):
    files = _files(spark, sf_dir).select("parent", "path")
    return transfer.transfer_ordinals(files, slice_rows=16)


_COLLIDING = "select path, regexp_extract(path, '/([a-z]+)/doc_', 1) || '_' || size || '.txt' as label from objects where type = 'file'"


def _colliding(spark, sf_dir):
    """Files renamed to language and size, so that many share a name."""
    name = F.concat(F.element_at(F.split("parent", "/"), -1), F.lit("_"), "size", F.lit(".txt"))
    return _files(spark, sf_dir).select("path", name.alias("label"))


@query(f"select label, min(path) as path from ({_COLLIDING}) group by label", views=("objects",))
def first_wins_per_name(spark, sf_dir):
    return transfer.first_wins(_colliding(spark, sf_dir)).select("label", "path")


@query(
    """
    select r.rid, r.path, count(o.path) as n_files, count(o.path) = 0 as empty
    from asked r left join objects o
      on o.type = 'file' and (o.path = r.np or o.parent = r.np) and contains(lower(o.path), '/en/')
    group by r.rid, r.path
    """,
    views=("objects", "asked"),
)
def match_count_guard(spark, sf_dir):
    picked = selection.select_files(fx.objects(spark, sf_dir), FileRules(include_patterns=["/EN/"]))
    return transfer.selected_per_request(fx.requests(spark, sf_dir), picked)


@query(
    """
    select parent, page, string_agg(label, ', ' order by label) as names
    from (select *, (row_number() over (partition by parent order by label) - 1) // 20 as page
          from objects where type = 'file')
    group by parent, page
    """,
    views=("objects",),
)
def pulled_names(spark, sf_dir):
    return transfer.pulled_names(_files(spark, sf_dir), page_size=20)


@query(
    f"""
    select o.path, o.label, o.ordinal, case when {_TAKEN} then 'skip' else 'copy' end as action, v.status
    from (select *, row_number() over (partition by parent order by path) - 1 as ordinal
          from objects where type = 'file' and (contains(lower(path), 'src1') or contains(lower(path), '/de/'))) o
    join ({_VERIFY}) v on v.name = o.label
    """,
    views=("objects", "manifest"),
)
def export_directory(spark, sf_dir):
    rules = FileRules(include_patterns=["src1", "/DE/"])
    picked = selection.select_files(fx.objects(spark, sf_dir), rules)
    plan = content.plan_export(picked, _labelled(spark, sf_dir), manifest=fx.manifest(spark, sf_dir))
    return plan.select("path", "label", "ordinal", "action", "status")


_TREE = "'/root/testdata/sf0.01/*'"


@query(f"select parse_filename(filename) as label, size from read_blob({_TREE})")
def scan_local_files(spark, sf_dir):
    return tree.list_local_files(spark, sf_dir).select("label", "size")


@query(
    f"""
    select parse_filename(filename) as label, size from read_blob({_TREE})
    where (contains(lower(filename), 'or') or parse_filename(filename) = 'part.parquet')
      and not contains(lower(filename), 'label')
    """
)
def select_local_files(spark, sf_dir):
    rules = FileRules(["OR"], ["part.parquet"], ["Label"], ["nothing.parquet"])
    return tree.list_local_files(spark, sf_dir, rules).select("label", "size")


@query(f"select parse_filename(filename) as label, size, md5(content) as md5 from read_blob({_TREE})")
def read_file_bytes(spark, sf_dir):
    return tree.file_digests(tree.list_local_files(spark, sf_dir)).select("label", "size", "md5")


@query(
    f"""
    select '/store/home/raw/' || parse_filename(filename) as path, parse_filename(filename) as label, size,
           md5(content) as md5
    from read_blob({_TREE}) where parse_filename(filename) = 'documents.parquet'
    """
)
def ingest_file(spark, sf_dir):
    store = scratch_path(spark, "store")
    content.ingest_directory(spark, f"{sf_dir}/documents.parquet", store, "/store/home/raw")
    content.ingest_directory(spark, f"{sf_dir}/documents.parquet", store, "/store/home/raw")
    stored = content.stored_files(content.open_store(spark, store))
    return stored.select("path", "label", "size", "md5")


@query(
    f"""
    select '/store/home/raw/' || parse_filename(filename) as path, parse_filename(filename) as label, size,
           md5(content) as md5
    from read_blob({_TREE}) where not contains(filename, 'region')
    """
)
def ingest_directory(spark, sf_dir):
    store = scratch_path(spark, "store")
    content.ingest_directory(spark, f"{sf_dir}/documents.parquet", store, "/store/home/raw")
    rules = FileRules(exclude_patterns=["REGION"])
    content.ingest_directory(spark, sf_dir, store, "/store/home/raw/", rules)
    stored = content.stored_files(content.open_store(spark, store))
    return stored.select("path", "label", "size", "md5")


@query(
    "select 'doc_' || doc_id || '.txt' as label, cast(strlen(text) as bigint) as size, md5(text) as md5 from documents"
)
def export_file(spark, sf_dir):
    directory = scratch_path(spark, "export")
    docs = fx.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("name"),
        F.lit(0).cast("long").alias("part"),
        F.col("text").cast("binary").alias("content"),
        F.lit(True).alias("last"),
    )
    content.export_rows(docs, directory)
    return tree.file_digests(tree.list_local_files(spark, directory)).select("label", "size", "md5")


@query(f"select parse_filename(filename) as label, size, md5(content) as md5 from read_blob({_TREE})")
def copy_round_trip(spark, sf_dir):
    store, directory = scratch_path(spark, "store"), scratch_path(spark, "export")
    content.ingest_directory(spark, sf_dir, store, "/store/home/raw")
    content.export_directory(spark, store, "/store/home/raw", directory)
    return tree.file_digests(tree.list_local_files(spark, directory)).select("label", "size", "md5")


@query(
    f"""
    select 'first' as run, count(*) as copied, cast(0 as bigint) as skipped from read_blob({_TREE})
    union all
    select 'again', 0, count(*) from read_blob({_TREE})
    """
)
def export_report(spark, sf_dir):
    store, directory = scratch_path(spark, "store"), scratch_path(spark, "export")
    content.ingest_directory(spark, sf_dir, store, "/store/home/raw")
    runs = [(name, *content.export_directory(spark, store, "/store/home/raw", directory)) for name in ("first", "again")]
    return spark.createDataFrame(runs, "run string, copied long, skipped long")


_DOCUMENT_FILES = "select 'doc_' || doc_id || '.txt' as label, cast(strlen(text) as bigint) as size, md5(text) as md5 from documents"


def _document_ranges(spark, sf_dir, length=1000):
    """The documents as files, in ranges of so many bytes that lie in any order."""
    data = fx.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("data")
    )
    size = F.length("data")
    starts = F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(length))
    cut = data.select("name", "data", F.explode(starts).alias("offset"))
    last = F.col("offset") + length >= size
    content = F.substring("data", F.col("offset") + 1, F.lit(length))
    return cut.select("name", "offset", content.alias("content"), last.alias("last")).repartition(16, "name", "offset")


@query(f"select *, cast(greatest(1, ceil(size / 1000)) as bigint) as ranges from ({_DOCUMENT_FILES})")
def export_ranges(spark, sf_dir):
    directory = scratch_path(spark, "export")
    done = write_ranges(_document_ranges(spark, sf_dir), directory).filter("published")
    files = tree.file_digests(tree.list_local_files(spark, directory)).select("label", "size", "md5")
    return files.join(done.select(F.col("name").alias("label"), "ranges"), "label")


@query(_DOCUMENT_FILES.replace(", md5(text) as md5", ""))
def scan_folder_slices(spark, sf_dir):
    directory = scratch_path(spark, "export")
    write_ranges(_document_ranges(spark, sf_dir, length=1 << 20), directory)
    return tree.list_local_files(spark, directory, slice_bytes=1 << 12).select("label", "size")


@query(
    f"""
    select 'all but one' as run, count(*) - 1 as copied, cast(0 as bigint) as skipped from read_blob({_TREE})
    union all
    select 'all', 1, count(*) - 1 from read_blob({_TREE})
    """
)
def export_partial_repeat(spark, sf_dir):
    store, directory = scratch_path(spark, "store"), scratch_path(spark, "export")
    content.ingest_directory(spark, sf_dir, store, "/store/home/raw")
    rules = FileRules(exclude_names=["orders.parquet"])
    first = content.export_directory(spark, store, "/store/home/raw", directory, rules)
    again = content.export_directory(spark, store, "/store/home/raw", directory)
    return spark.createDataFrame([("all but one", *first), ("all", *again)], "run string, copied long, skipped long")
