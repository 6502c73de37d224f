"""Tag queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import tags
from shelfmark.plans import fixtures as fx
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources import responses
from shelfmark.sources.buckets import BucketedTable


def _tags(spark, sf_dir):
    return tags.valid_tags(fx.tagspec(spark, sf_dir))


@query('select id, ns, attr, "value", unit, "value" is null as rejected from parsed', views=("parsed",))
def parse_tags(spark, sf_dir):
    return tags.parse_tags(fx.tagspec(spark, sf_dir))


@query(
    """
    select * from tags where id not in (select id from retail)
    union all
    select * from retail
    """,
    views=("tags", "retail"),
)
def overwrite_tags(spark, sf_dir):
    incoming = tags.valid_tags(fx.retail_specs(spark, sf_dir))
    return tags.overwrite_tags(_tags(spark, sf_dir), incoming)


@query(
    """
    select * from tags where id not in (select id from retail)
    union all
    select * from retail
    """,
    views=("tags", "retail"),
)
def overwrite_tags_bucketed(spark, sf_dir):
    incoming = tags.valid_tags(fx.retail_specs(spark, sf_dir))
    schema = "id string, ns string, attr string, value string, unit string"
    table = BucketedTable(spark, scratch_path(spark, "tags"), ["id"], schema, buckets=16)
    table.write(_tags(spark, sf_dir))
    table.change(incoming.select("id"), lambda current: tags.overwrite_tags(current, incoming))
    return table.read()


# The parts' own specs posted again: those with a malformed one keep what they had.
@query(
    """
    select * from retail where id in (select id from parsed where "value" is null)
    union all
    select id, ns, attr, "value", unit from parsed
    where id not in (select id from parsed where "value" is null)
    """,
    views=("parsed", "retail"),
)
def post_tags(spark, sf_dir):
    current = tags.valid_tags(fx.retail_specs(spark, sf_dir))
    return tags.post_tags(current, fx.tagspec(spark, sf_dir))


@query(
    """select id, count(*) as n_rejected from parsed where "value" is null group by id""", views=("parsed",)
)
def rejected_tag_posts(spark, sf_dir):
    return tags.rejected_posts(fx.tagspec(spark, sf_dir))


@query(
    """
    select * from tags where ns = 'irods-avus'
    and id in (select cast(l_partkey as varchar) from lineitem where l_returnflag = 'R')
    """,
    views=("tags",),
)
def get_tags(spark, sf_dir):
    returned = fx.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    ids = returned.select(F.col("l_partkey").cast("string").alias("id"))
    return tags.get_tags(_tags(spark, sf_dir), ids, irods=True)


@query(
    """
    select id, ns, page, string_agg(line, chr(10) order by line) as tags
    from (select *, (row_number() over (partition by id, ns order by line) - 1) // 2 as page
          from (select id, ns, attr || '=' || "value" as line from tags))
    group by id, ns, page
    """,
    views=("tags",),
)
def render_tags(spark, sf_dir):
    return tags.render_tags(_tags(spark, sf_dir), page_size=2)


_AVU = """'{"attr":"' || attr || '","value":"' || "value" || '","unit":""}'"""


@query(
    f"""
    select id, '{{"avus":[' || coalesce(string_agg({_AVU}, ',' order by attr, "value") filter (ns = 'avus'), '')
           || '],"irods-avus":[' || coalesce(string_agg({_AVU}, ',' order by attr, "value") filter (ns = 'irods-avus'), '')
           || ']}}' as payload
    from tags group by id
    """,
    views=("tags",),
)
def tag_payload(spark, sf_dir):
    return tags.tag_payloads(_tags(spark, sf_dir))


@query(
    """
    select id, count(*) filter (ns = 'avus') as n_avus, count(*) filter (ns = 'irods-avus') as n_irods_avus
    from tags group by id having bool_or(attr = 'brand' and "value" = 'Brand#2')
    """,
    views=("tags",),
)
def has_tag(spark, sf_dir):
    return tags.has_tag(_tags(spark, sf_dir), "brand", "Brand#2")


@query("select * from tags", views=("tags",))
def read_tag_payloads(spark, sf_dir):
    posted = tags.tag_payloads(_tags(spark, sf_dir))
    log = posted.select(F.col("id").alias("rid"), F.col("payload").alias("body"))
    return responses.tag_rows(log).select(F.col("rid").alias("id"), "ns", "attr", "value", "unit")
