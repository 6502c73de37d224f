"""Catalog, tag, grant and log tables derived from the test tables.

Each view exists twice: as a DataFrame and as SQL text for the oracle.  The two
are written separately on purpose.  Every view covers its whole table; variety
(bad digests, missing paths, malformed specs) comes from CASE, not from filters.
The one exception is ``retail_specs``, whose feature is to post for some ids only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOME = "/store/home"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _home(*parts) -> Column:
    return F.concat(F.lit(HOME + "/"), *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _doc_name() -> Column:
    return F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt"))


def _doc_dir() -> Column:
    return _home(F.col("source"), "/", F.col("lang"))


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.select(
        F.concat(_doc_dir(), F.lit("/"), _doc_name()).alias("path"),
        _doc_name().alias("label"),
        _doc_dir().alias("parent"),
        F.lit("file").alias("type"),
        F.col("doc_id").cast("string").alias("id"),
        F.md5(F.col("text").cast("binary")).alias("md5"),
        F.octet_length("text").cast("long").alias("size"),
    )
    # Two levels of directories from one pass over the distinct pairs.
    inner = F.struct(_doc_dir().alias("path"), F.col("lang").alias("label"), _home(F.col("source")).alias("parent"))
    outer = F.struct(_home(F.col("source")).alias("path"), F.col("source").alias("label"), F.lit(HOME).alias("parent"))
    dirs = docs.select("source", "lang").distinct().select(F.inline(F.array(inner, outer))).distinct()
    return files.union(dirs.select("*", F.lit("dir"), _null("string"), _null("string"), _null("long")))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    ghost = F.concat(F.lit("ghost_"), F.col("doc_id"), F.lit(".txt"))
    listed = docs.select(
        F.when(F.col("doc_id") % 17 == 0, ghost).otherwise(_doc_name()).alias("name"),
        F.md5(text.cast("binary")).alias("checksum"),
    )
    labelled = F.when(F.col("toxic") == 1, _doc_name()).otherwise(F.concat(F.lit("label_"), "doc_id"))
    again = table(spark, sf_dir, "labels").select(labelled, F.lit("relisted"))
    return listed.union(again)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    file = F.concat(_doc_dir(), F.lit("/"), _doc_name())
    kind = F.col("doc_id") % 3
    path = (
        F.when(kind == 0, F.concat(file, F.lit("/")))
        .when(kind == 1, file)
        .otherwise(_home(F.col("source"), "/nope_", F.col("doc_id")))
    )
    per_doc = docs.select(F.col("doc_id").alias("rid"), path.alias("path"))
    first = F.min("doc_id").alias("first")
    inner = docs.groupBy("source", "lang").agg(first).select(
        -2 * F.col("first") - 1, F.concat(_doc_dir(), F.lit("/"))
    )
    outer = docs.groupBy("source").agg(first).select(-2 * F.col("first") - 2, _home(F.col("source")))
    return per_doc.union(inner).union(outer)


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(table(spark, sf_dir, "events"))


def change_log(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("seq"),
        "ts",
        F.col("user_id").alias("usr"),
        _home("k", _k()).alias("path"),
        F.when(kind == "error", F.lit("unshare")).otherwise(F.lit("share")).alias("action"),
        F.when(kind == "purchase", F.lit("write")).when(kind != "error", F.lit("read")).alias("permission"),
    )


def _home_or_tmp() -> Column:
    root = F.when(F.col("value") < 5, F.lit("/tmp")).otherwise(F.lit(HOME))
    return F.concat(root, F.lit("/k"), _k())


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single share changes, some with a bad path or permission."""
    value = F.col("value")
    permission = F.when(value > 60, F.lit("own")).when(value > 20, F.lit("write")).otherwise(F.lit("read"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("usr"),
        _home_or_tmp().alias("path"),
        permission.alias("permission"),
    )


def views_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revocations: ``rid, usr, path``, some outside the home root."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("rid"), F.col("user_id").alias("usr"), _home_or_tmp().alias("path")
    )


def share_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of two pairs each: ``rid, usr, paths``."""
    kind = F.col("event_type")
    permission = F.when(kind == "purchase", F.lit("write")).when(kind == "error", F.lit("own")).otherwise(F.lit("read"))
    other = F.when(F.col("event_id") % 11 == 0, F.lit("/tmp/x")).otherwise(F.lit(HOME + "/common"))

    def pair(path: Column, allowed: Column) -> Column:
        return F.struct(path.alias("path"), allowed.alias("permission"))

    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("rid"),
        F.col("user_id").alias("usr"),
        F.array(pair(_home("k", _k()), permission), pair(other, F.lit("read"))).alias("paths"),
    )


def tagspec(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string").alias("id")
    size = F.col("p_size")
    brand = part.select(
        key, F.lit("avus").alias("ns"), F.concat(F.lit("\t brand="), "p_brand", F.lit(" \n")).alias("spec")
    )
    kind = part.select(key, F.lit("avus"), F.concat(F.lit("type="), "p_type", F.lit("=extra")))
    third = part.select(
        key,
        F.when(size > 25, F.lit("irods-avus")).otherwise(F.lit("avus")),
        F.when(size % 10 == 3, F.lit("malformed")).otherwise(F.concat(F.lit("size="), size)),
    )
    return brand.union(kind).union(third)


def retail_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags to overwrite with, for the larger parts."""
    return table(spark, sf_dir, "part").filter("p_size > 30").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.lit("avus").alias("ns"),
        F.concat(F.lit("retail="), F.col("p_size")).alias("spec"),
    )


def resplog(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    kind = F.col("event_type")
    endpoints = ["stat", "list", "upload", "download", "token", "exists"]
    codes = ["ERR_DOES_NOT_EXIST", "ERR_EXISTS", "ERR_REQUEST_FAILED"]
    endpoint = F.element_at(F.array(*[F.lit(e) for e in endpoints]), (event % 6 + 1).cast("int"))
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.floor(event / 6) % 3 + 1).cast("int"))
    status = (
        F.when(kind == "error", 500).when(kind == "signup", 400).when(kind == "purchase", 401).otherwise(200)
    )
    body = (
        F.when(kind == "error", F.concat(F.lit('{"error_code":"'), code, F.lit('"}')))
        .when(event % 7 == 0, F.lit('{"other":1}'))
        .when(event % 11 == 0, F.lit('{"paths":null}'))
        .otherwise(F.concat(F.lit('{"paths":{"/k'), _k(), F.lit('":true,"/z":false}}')))
    )
    asked = F.when(kind == "view", F.concat(F.lit("/k"), _k())).otherwise(F.lit("/z"))
    return table(spark, sf_dir, "events").select(
        event.alias("rid"),
        endpoint.alias("endpoint"),
        status.alias("status"),
        body.alias("body"),
        asked.alias("path"),
    )


def null_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    text = F.concat(
        F.lit('{"k":'), event, F.lit(',"u":'), F.when(event % 2 == 0, F.lit("null")).otherwise(F.lit("1")),
        F.lit(',"n":{"x":null,"y":'), event % 5, F.lit('},"p":'), F.col("props"), F.lit(',"l":[{"z":null}]}'),
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("j"))


def byte_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.floor(F.col("l_extendedprice") * F.pow(F.lit(7.0), F.col("l_linenumber") * 2)).cast("long")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("ln"), n.alias("n")
    )


_K = "json_extract_string(props, '$.k')"
_ROOT = "case when value < 5 then '/tmp' else '/store/home' end"
_DIR = "'/store/home/' || source || '/' || lang"
_NAME = "'doc_' || doc_id || '.txt'"
_BARE = "rtrim(path, '/')"

# Oracle text of the views above, and of the results several queries start from.
VIEW_SQL = {
    "objects": f"""
        select {_DIR} || '/' || {_NAME} as path, {_NAME} as label, {_DIR} as parent, 'file' as type,
               cast(doc_id as varchar) as id, md5(text) as md5, cast(strlen(text) as bigint) as size
        from documents
        union all
        select distinct {_DIR}, lang, '/store/home/' || source, 'dir', null, null, null from documents
        union all
        select distinct '/store/home/' || source, source, '/store/home', 'dir', null, null, null from documents""",
    "manifest": f"""
        select case when doc_id % 17 = 0 then 'ghost_' || doc_id || '.txt' else {_NAME} end as name,
               case when doc_id % 10 = 0 then md5(text || 'x') else md5(text) end as checksum
        from documents
        union all
        select case when toxic = 1 then {_NAME} else 'label_' || doc_id end, 'relisted' from labels""",
    "requests": f"""
        select doc_id as rid,
               case doc_id % 3 when 0 then {_DIR} || '/' || {_NAME} || '/'
                               when 1 then {_DIR} || '/' || {_NAME}
                               else '/store/home/' || source || '/nope_' || doc_id end as path
        from documents
        union all
        select -2 * min(doc_id) - 1, {_DIR} || '/' from documents group by source, lang
        union all
        select -2 * min(doc_id) - 2, '/store/home/' || source from documents group by source""",
    "asked": f"select rid, path, {_BARE} as np from requests",
    "changes": f"""
        select event_id as seq, ts, user_id as usr, '/store/home/k' || {_K} as path,
               case event_type when 'error' then 'unshare' else 'share' end as action,
               case when event_type = 'purchase' then 'write' when event_type <> 'error' then 'read' end as permission
        from events""",
    "in_force": """
        select usr, path, permission from (
            select *, row_number() over (partition by usr, path order by ts desc, seq desc) as rn from changes
        ) where rn = 1 and action = 'share'""",
    "clicks": f"""
        select event_id as seq, user_id as usr, {_ROOT} || '/k' || {_K} as path,
               case when value > 60 then 'own' when value > 20 then 'write' else 'read' end as permission
        from events""",
    "views_seen": f"""
        select event_id as rid, user_id as usr, {_ROOT} || '/k' || {_K} as path
        from events""",
    "share_pairs": f"""
        select event_id as rid, user_id as usr, 0 as pos, '/store/home/k' || {_K} as path,
               case event_type when 'purchase' then 'write' when 'error' then 'own' else 'read' end as permission
        from events
        union all
        select event_id, user_id, 1, case when event_id % 11 = 0 then '/tmp/x' else '/store/home/common' end, 'read'
        from events""",
    "tagspec": """
        select cast(p_partkey as varchar) as id, 'avus' as ns, chr(9) || ' brand=' || p_brand || ' ' || chr(10) as spec
        from part
        union all
        select cast(p_partkey as varchar), 'avus', 'type=' || p_type || '=extra' from part
        union all
        select cast(p_partkey as varchar), case when p_size > 25 then 'irods-avus' else 'avus' end,
               case when p_size % 10 = 3 then 'malformed' else 'size=' || p_size end
        from part""",
    "parsed": """
        select id, ns, string_split(trimmed, '=')[1] as attr, string_split(trimmed, '=')[2] as "value", '' as unit
        from (select id, ns, regexp_replace(spec, '^\\s+|\\s+$', '', 'g') as trimmed from tagspec)""",
    "tags": """select * from parsed where "value" is not null""",
    "retail": """
        select cast(p_partkey as varchar) as id, 'avus' as ns, 'retail' as attr,
               cast(p_size as varchar) as "value", '' as unit
        from part where p_size > 30""",
    "resplog": f"""
        select event_id as rid,
               case event_id % 6 when 0 then 'stat' when 1 then 'list' when 2 then 'upload'
                                 when 3 then 'download' when 4 then 'token' else 'exists' end as endpoint,
               case event_type when 'error' then 500 when 'signup' then 400 when 'purchase' then 401 else 200 end as status,
               case when event_type = 'error' then case (event_id // 6) % 3
                         when 0 then '{{"error_code":"ERR_DOES_NOT_EXIST"}}'
                         when 1 then '{{"error_code":"ERR_EXISTS"}}'
                         else '{{"error_code":"ERR_REQUEST_FAILED"}}' end
                    when event_id % 7 = 0 then '{{"other":1}}'
                    when event_id % 11 = 0 then '{{"paths":null}}'
                    else '{{"paths":{{"/k' || {_K} || '":true,"/z":false}}}}' end as body,
               case event_type when 'view' then '/k' || {_K} else '/z' end as path
        from events""",
    "null_documents": """
        select event_id, '{"k":' || event_id || ',"u":' || case when event_id % 2 = 0 then 'null' else '1' end
               || ',"n":{"x":null,"y":' || event_id % 5 || '},"p":' || props || ',"l":[{"z":null}]}' as j
        from events""",
    "byte_counts": """
        select l_orderkey as k, cast(l_linenumber as bigint) as ln,
               cast(floor(l_extendedprice * power(7, l_linenumber * 2)) as bigint) as n
        from lineitem""",
}

# Views that select from other views.
_NEEDS = {
    "asked": ("requests",),
    "in_force": ("changes",),
    "parsed": ("tagspec",),
    "tags": ("parsed",),
}


def with_views(views: tuple[str, ...], body: str) -> str:
    """``body`` preceded by the views it names and those they need."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for needed in _NEEDS.get(view, ()):
            add(needed)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{view} as ({VIEW_SQL[view]})" for view in ordered)
    return f"with {parts}\n{body.strip()}"
