"""Listing, selection and lookup queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.paths import join_path, label_of, normalize_path, parent_of, under_home
from shelfmark.functions.patterns import FileRules, labelled_in, matches_any, named_in
from shelfmark.operators import listing, lookup, selection
from shelfmark.operators.grants import check_grants
from shelfmark.operators.ranks import pages_within
from shelfmark.plans import fixtures as fx
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources import responses
from shelfmark.sources.catalog import read_catalog, write_catalog, write_lookup_catalog

SRC1 = "/store/home/src1"

RULES = FileRules(
    include_patterns=["SRC1", "/de/"],
    include_names=["doc_7.txt", "/store/home/src0/fr/doc_0.txt"],
    exclude_patterns=["_1"],
    exclude_names=["doc_33.txt", "doc_20.txt"],
)

_INCLUDED = """(contains(lower(path), 'src1') or contains(lower(path), '/de/')
    or label in ('doc_7.txt', '/store/home/src0/fr/doc_0.txt')
    or path in ('doc_7.txt', '/store/home/src0/fr/doc_0.txt'))"""


@query(
    "select path, label, type from objects where parent = '/store/home/src1'",
    views=("objects",),
)
def list_directory(spark, sf_dir):
    found = listing.list_directory(fx.objects(spark, sf_dir), SRC1 + "/")
    return found.filter("status = 'ok'").select("path", "label", "type")


# A directory, one known only from its children, a file, and a path that does not exist.
@query(
    """
    select p as asked, o.path, 'ok' as status
    from (values ('/store/home/src1'), ('/store/home')) t(p) join objects o on o.parent = p
    union all
    select p, p, 'invalid_path'
    from (values ('/store/home/src1/en/doc_1.txt'), ('/store/none')) t(p)
    """,
    views=("objects",),
)
def list_directory_status(spark, sf_dir):
    asked = [SRC1 + "/", "/store/home", SRC1 + "/en/doc_1.txt", "/store/none"]
    found = [
        listing.list_directory(fx.objects(spark, sf_dir), path).select(F.lit(path.rstrip("/")).alias("asked"), "path", "status")
        for path in asked
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "select path, label, type from objects where parent = '/store/home/src1/en'",
    views=("objects",),
)
def list_stored_directory(spark, sf_dir):
    location = scratch_path(spark, "catalog")
    write_catalog(fx.objects(spark, sf_dir), location)
    found = listing.list_directory(read_catalog(spark, location), SRC1 + "/en")
    return found.filter("status = 'ok'").select("path", "label", "type")


@query(
    "select path, label, md5, size from objects where parent = '/store/home/src1/en' and type = 'file'",
    views=("objects",),
)
def list_files(spark, sf_dir):
    found = listing.list_files(fx.objects(spark, sf_dir), SRC1 + "/en")
    return found.select("path", "label", "md5", "size")


@query(
    "select path, label from objects where parent = '/store/home/src1' and type = 'dir'",
    views=("objects",),
)
def list_folders(spark, sf_dir):
    return listing.list_folders(fx.objects(spark, sf_dir), SRC1).select("path", "label")


@query(
    """
    select rid as ord, np as directory, label, o.type, 'ok' as status
    from asked join objects o on parent = np
    union all
    select rid, np, null, null, case when d.path is null then 'invalid_path' else 'empty' end
    from asked left join objects d on d.path = np and d.type = 'dir'
    where np not in (select parent from objects)
    """,
    views=("objects", "asked"),
)
def list_many_directories(spark, sf_dir):
    asked = fx.requests(spark, sf_dir).withColumnRenamed("rid", "ord")
    return listing.list_many(asked, fx.objects(spark, sf_dir))


@query(
    """
    select path, label, type from objects where parent = '/store/home/src1/en'
    order by label limit 10
    """,
    views=("objects",),
)
def directory_page(spark, sf_dir):
    page = listing.list_directory(fx.objects(spark, sf_dir), SRC1 + "/en", limit=10)
    return page.filter("status = 'ok'").select("path", "label", "type")


@query(
    """
    select parent, page,
           coalesce(string_agg(label, ',' order by label) filter (type = 'file'), '') as files,
           coalesce(string_agg(label, ',' order by label) filter (type = 'dir'), '') as folders
    from (select *, (row_number() over (partition by parent order by label, type) - 1) // 25 as page
          from objects)
    group by parent, page
    """,
    views=("objects",),
)
def nested_listing(spark, sf_dir):
    pages = listing.nested_listing(fx.objects(spark, sf_dir), page_size=25)
    return pages.select(
        "parent",
        "page",
        F.array_join("files", ",").alias("files"),
        F.array_join("folders", ",").alias("folders"),
    )


@query(
    """
    select path, type from objects
    union
    select distinct np, 'dir' from asked where np not in (select path from objects)
    """,
    views=("objects", "asked"),
)
def make_directories(spark, sf_dir):
    made = listing.make_directories(fx.objects(spark, sf_dir), fx.requests(spark, sf_dir))
    return made.select("path", "type")


@query("select path, label, parent, true as rejoined from objects", views=("objects",))
def path_parts(spark, sf_dir):
    path = F.col("path")
    return fx.objects(spark, sf_dir).select(
        "path",
        label_of(path).alias("label"),
        parent_of(path).alias("parent"),
        (join_path(parent_of(path), label_of(path)) == path).alias("rejoined"),
    )


@query("select path, np as normalized from asked", views=("asked",))
def normalize_paths(spark, sf_dir):
    return fx.requests(spark, sf_dir).select("path", normalize_path(F.col("path")).alias("normalized"))


@query("select label from objects where type = 'file'", views=("objects",))
def project_paths(spark, sf_dir):
    return listing.of_type(fx.objects(spark, sf_dir), "file").select("label")


@query("select path from objects where type = 'dir'", views=("objects",))
def filter_by_type(spark, sf_dir):
    return listing.of_type(fx.objects(spark, sf_dir), "dir").select("path")


@query(
    """
    select path, contains(lower(path), 'src1') or contains(lower(path), '/en/') or contains(lower(path), '%') as hit
    from objects
    """,
    views=("objects",),
)
def match_any_pattern(spark, sf_dir):
    hit = matches_any(F.col("path"), ["SRC1", "/en/", "%"])
    return fx.objects(spark, sf_dir).select("path", hit.alias("hit"))


def _files(spark, sf_dir):
    return listing.of_type(fx.objects(spark, sf_dir), "file")


@query(
    """
    select path from objects
    where type = 'file' and (contains(lower(path), 'src1') or contains(lower(path), '/de/'))
    """,
    views=("objects",),
)
def include_by_pattern(spark, sf_dir):
    rules = FileRules(include_patterns=RULES.include_patterns)
    return selection.select_files(fx.objects(spark, sf_dir), rules).select("path")


@query(
    """
    select path from objects
    where type = 'file' and (label in ('doc_7.txt', '/store/home/src0/fr/doc_0.txt')
                             or path in ('doc_7.txt', '/store/home/src0/fr/doc_0.txt'))
    """,
    views=("objects",),
)
def include_by_name(spark, sf_dir):
    named = named_in(F.col("label"), F.col("path"), RULES.include_names)
    return _files(spark, sf_dir).filter(named).select("path")


@query(f"select path from objects where type = 'file' and {_INCLUDED}", views=("objects",))
def include_union(spark, sf_dir):
    rules = FileRules(RULES.include_patterns, RULES.include_names)
    return selection.select_files(fx.objects(spark, sf_dir), rules).select("path")


@query(
    "select path from objects where type = 'file' and not contains(path, '_1')", views=("objects",)
)
def exclude_by_pattern(spark, sf_dir):
    rules = FileRules(exclude_patterns=RULES.exclude_patterns)
    return selection.select_files(fx.objects(spark, sf_dir), rules).select("path")


@query(
    """
    select path from objects
    where type = 'file' and label not in ('doc_33.txt', 'doc_20.txt', '/store/home/src0/fr/doc_0.txt')
    """,
    views=("objects",),
)
def exclude_by_name(spark, sf_dir):
    names = [*RULES.exclude_names, "/store/home/src0/fr/doc_0.txt"]
    return _files(spark, sf_dir).filter(~labelled_in(F.col("label"), names)).select("path")


@query(
    f"""
    select path from objects where type = 'file' and {_INCLUDED}
    and not contains(lower(path), '_1') and label not in ('doc_33.txt', 'doc_20.txt')
    """,
    views=("objects",),
)
def select_files(spark, sf_dir):
    return selection.select_files(fx.objects(spark, sf_dir), RULES).select("path")


@query(
    """
    select path from objects where exists (
        select 1 from (select distinct case when n_chars > 10000 then upper(source || '/' || lang) else 'OC_' || doc_id || '7.T' end as pattern from documents)
        where contains(lower(path), lower(pattern)))
    """,
    views=("objects",),
)
def pattern_semi_join(spark, sf_dir):
    folder = F.upper(F.concat("source", F.lit("/"), "lang"))
    name = F.concat(F.lit("OC_"), "doc_id", F.lit("7.T"))
    docs = fx.table(spark, sf_dir, "documents")
    patterns = docs.select(F.when(F.col("n_chars") > 10000, folder).otherwise(name).alias("pattern"))
    return selection.match_pattern_table(fx.objects(spark, sf_dir), patterns).select("path")


@query(
    """
    select path from objects where exists (
        select 1 from (select distinct 'OC_' || (user_id * 100 + cast(json_extract_string(props, '$.k') as bigint)) || '.T'
                       as pattern from events)
        where contains(lower(path), lower(pattern)))
    """,
    views=("objects",),
)
def pattern_table_join(spark, sf_dir):
    number = F.col("user_id") * 100 + F.get_json_object("props", "$.k").cast("long")
    patterns = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("OC_"), number, F.lit(".T")).alias("pattern")
    )
    return selection.match_pattern_table(fx.objects(spark, sf_dir), patterns).select("path")


@query(
    """
    select path from objects where type = 'file' and contains(path, '/en/')
    union
    select path from objects where type = 'file' and size > 5000
    """,
    views=("objects",),
)
def union_distinct(spark, sf_dir):
    files = _files(spark, sf_dir)
    english = files.filter(matches_any(F.col("path"), ["/en/"])).select("path")
    return selection.union_distinct(english, files.filter("size > 5000").select("path"))


@query(
    """
    select path from objects where type = 'file'
    and label not in (select 'doc_' || doc_id || '.txt' from labels)
    """,
    views=("objects",),
)
def difference(spark, sf_dir):
    labelled = fx.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("label")
    )
    return selection.difference(_files(spark, sf_dir), labelled, on="label").select("path")


@query(
    """
    select a.rid, a.path, o.label, o.type, o.id, o.md5, o.size, o.path is not null as found
    from asked a left join objects o on o.path = a.np
    """,
    views=("objects", "asked"),
)
def stat_paths(spark, sf_dir):
    return lookup.stat_paths(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir))


def _exists_sql(condition: str) -> str:
    return f"""
    select a.rid, a.path, {condition} as "exists"
    from asked a left join objects o on o.path = a.np
    """


@query(_exists_sql("o.path is not null"), views=("objects", "asked"))
def paths_exist(spark, sf_dir):
    return lookup.paths_exist(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir))


@query(_exists_sql("coalesce(o.type = 'dir', false)"), views=("objects", "asked"))
def dirs_exist(spark, sf_dir):
    return lookup.type_exists(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir), "dir")


@query(_exists_sql("coalesce(o.type = 'file', false)"), views=("objects", "asked"))
def files_exist(spark, sf_dir):
    return lookup.type_exists(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir), "file")


@query(
    """
    select rid, want, case
        when want is null then case when o.path is null then 'no' else 'yes' end
        when want not in ('dir', 'file') then 'bad_type'
        when o.type = want then 'yes' else 'no' end as result
    from (select *, case abs(rid) % 4 when 0 then 'dir' when 1 then 'file' when 2 then 'link' end as want from asked) a
    left join objects o on o.path = a.np
    """,
    views=("objects", "asked"),
)
def exists_by_type(spark, sf_dir):
    kind = F.abs("rid") % 4
    want = F.when(kind == 0, F.lit("dir")).when(kind == 1, F.lit("file")).when(kind == 2, F.lit("link"))
    asked = fx.requests(spark, sf_dir).withColumn("want", want)
    found = lookup.exists_by_type(asked, fx.objects(spark, sf_dir))
    return found.select("rid", "want", "result")


@query(
    """
    select o_orderkey as rid, username, c_nationkey as nation, c_mktsegment as segment, c_custkey is not null as found
    from (select o_orderkey, case when o_orderstatus = 'P' then 'Nobody#' || o_custkey
                             else 'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') end as username from orders)
    left join customer on c_name = username
    """
)
def lookup_users(spark, sf_dir):
    number = F.col("o_custkey").cast("string")
    known = F.concat(F.lit("Customer#"), F.lpad(number, 9, "0"))
    asked = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rid"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Nobody#"), number)).otherwise(known).alias("username"),
    )
    users = fx.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("username"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    return lookup.lookup_users(asked, users).select("rid", "username", "nation", "segment", "found")


@query(
    """
    select a.rid, a.np as target, o.type, case when o.path is null then 'missing' else 'ok' end as status
    from asked a left join objects o on o.path = a.np
    """,
    views=("objects", "asked"),
)
def request_targets(spark, sf_dir):
    return lookup.resolve_targets(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir)).targets


@query(
    """
    select np as target, path as file from (select distinct np from asked) a
    join objects o on o.type = 'file' and (o.path = np or o.parent = np)
    """,
    views=("objects", "asked"),
)
def target_files(spark, sf_dir):
    return lookup.resolve_targets(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir)).files


@query(
    """
    select rid as ord, np as directory, (select count(*) from objects where parent = np) as n_entries,
           case when np in (select parent from objects) then 'ok'
                when np in (select path from objects where type = 'dir') then 'empty' else 'invalid_path' end as status
    from asked
    """,
    views=("objects", "asked"),
)
def directory_answers(spark, sf_dir):
    asked = fx.requests(spark, sf_dir).withColumnRenamed("rid", "ord")
    return listing.list_targets(asked, fx.objects(spark, sf_dir))[0]


@query(
    "select parent as directory, label, type from objects where parent in (select np from asked)",
    views=("objects", "asked"),
)
def directory_entries(spark, sf_dir):
    asked = fx.requests(spark, sf_dir).withColumnRenamed("rid", "ord")
    return listing.list_targets(asked, fx.objects(spark, sf_dir))[1]


@query(
    """
    select a.rid, a.path, o.label, o.type, o.id, o.md5, o.size, o.path is not null as found
    from asked a left join objects o on o.path = a.np
    """,
    views=("objects", "asked"),
)
def stat_paths_bucketed(spark, sf_dir):
    location = scratch_path(spark, "lookup")
    table = location.rpartition("/")[2].replace("-", "_")
    stored = write_lookup_catalog(fx.objects(spark, sf_dir), table, location, buckets=8)
    return lookup.stat_paths(fx.requests(spark, sf_dir), stored)


@query(
    """
    select a.rid, a.np as target, o.path as file, 'ok' as status
    from asked a join objects o on o.type = 'file' and (o.path = a.np or o.parent = a.np)
    union all
    select rid, np, null, 'missing' from asked where np not in (select path from objects)
    """,
    views=("objects", "asked"),
)
def resolve_requests(spark, sf_dir):
    return lookup.resolve_requests(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir))


@query(
    "select seq, path, starts_with(path, '/store/home/') as home_ok from clicks", views=("clicks",)
)
def validate_home_prefix(spark, sf_dir):
    return fx.clicks(spark, sf_dir).select(
        "seq", "path", under_home(F.col("path"), fx.HOME).alias("home_ok")
    )


@query(
    "select seq, permission, permission in ('read', 'write') as permission_ok from clicks",
    views=("clicks",),
)
def validate_permission(spark, sf_dir):
    checked = check_grants(fx.clicks(spark, sf_dir), fx.HOME)
    return checked.select("seq", "permission", "permission_ok")


def _info(*names) -> Column:
    """The named columns as one JSON object, once rendered; nulls are left out."""
    return F.struct(*[F.col(n) for n in names])


@query("select parent, path, label, type, id, md5 from objects", views=("objects",))
def read_listings(spark, sf_dir):
    entry = _info("id", "path", "label", "md5")
    paged = pages_within(fx.objects(spark, sf_dir), ["parent"], ["label", "type"], 25)
    bodies = paged.groupBy(F.col("parent").alias("rid"), "page").agg(
        F.to_json(
            F.struct(
                F.collect_list(F.when(F.col("type") == "file", entry)).alias("files"),
                F.collect_list(F.when(F.col("type") == "dir", entry)).alias("folders"),
            )
        ).alias("body")
    )
    rows = responses.listing_rows(bodies)
    return rows.select(F.col("rid").alias("parent"), "path", "label", "type", "id", "md5")


@query("select path, label, parent, type, id, md5 from objects", views=("objects",))
def read_stats(spark, sf_dir):
    info = F.create_map("path", _info("id", "type", "md5"))
    log = fx.objects(spark, sf_dir).select(
        F.col("path").alias("rid"), F.to_json(F.struct(info.alias("paths"))).alias("body")
    )
    return responses.stat_rows(log).select("path", "label", "parent", "type", "id", "md5")


@query(_exists_sql("o.path is not null"), views=("objects", "asked"))
def read_existence(spark, sf_dir):
    found = lookup.paths_exist(fx.requests(spark, sf_dir), fx.objects(spark, sf_dir))
    body = F.to_json(F.struct(F.create_map("path", "exists").alias("paths")))
    return responses.existence_rows(found.select("rid", body.alias("body")))


@query("select c_name as username, c_mktsegment as segment from customer")
def read_users(spark, sf_dir):
    info = F.create_map("c_name", F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")))
    log = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("rid"), F.to_json(info).alias("body"))
    return responses.user_rows(log).select("username", F.col("info")["segment"].alias("segment"))
