"""Sharing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import grants
from shelfmark.plans import fixtures as fx
from shelfmark.plans.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources import responses
from shelfmark.sources.buckets import BucketedTable


def _in_force(spark, sf_dir):
    return grants.current_grants(fx.changes(spark, sf_dir))


@query("select * from in_force", views=("in_force",))
def current_grants(spark, sf_dir):
    return _in_force(spark, sf_dir)


_VALID = "starts_with(path, '/store/home/') and permission in ('read', 'write')"


def _upsert(changes: str, order: str) -> str:
    return f"""
    , latest as (
        select usr, path, permission from (
            select *, row_number() over (partition by usr, path order by {order}) as rn from {changes}
        ) where rn = 1)
    select * from in_force where (usr, path) not in (select (usr, path) from latest)
    union all
    select * from latest
    """


@query(_upsert(f"(select * from clicks where {_VALID})", "seq desc"), views=("in_force", "clicks"))
def share(spark, sf_dir):
    return grants.share(_in_force(spark, sf_dir), fx.clicks(spark, sf_dir), fx.HOME)


@query(_upsert(f"(select * from clicks where {_VALID})", "seq desc"), views=("in_force", "clicks"))
def share_bucketed(spark, sf_dir):
    clicks = fx.clicks(spark, sf_dir)
    schema = "usr bigint, path string, permission string"
    table = BucketedTable(spark, scratch_path(spark, "grants"), grants.GRANT_KEY, schema, buckets=16)
    table.write(_in_force(spark, sf_dir))
    table.change(clicks.select(*grants.GRANT_KEY), lambda current: grants.share(current, clicks, fx.HOME))
    return table.read()


@query(
    f"select rid, usr, bool_and({_VALID}) as ok from share_pairs group by rid, usr", views=("share_pairs",)
)
def check_share_requests(spark, sf_dir):
    checked = grants.check_share_requests(fx.share_requests(spark, sf_dir), fx.HOME)
    return checked.select("rid", "usr", "ok")


@query(
    _upsert(
        f"(select * from share_pairs where rid not in (select rid from share_pairs where not ({_VALID})))",
        "rid desc, pos desc",
    ),
    views=("in_force", "share_pairs"),
)
def share_many(spark, sf_dir):
    return grants.share_many(_in_force(spark, sf_dir), fx.share_requests(spark, sf_dir), fx.HOME)


@query(
    """
    select * from in_force where (usr, path) not in (
        select (usr, path) from views_seen where starts_with(path, '/store/home/'))
    """,
    views=("in_force", "views_seen"),
)
def unshare(spark, sf_dir):
    return grants.unshare(_in_force(spark, sf_dir), fx.views_seen(spark, sf_dir), fx.HOME)


@query(
    """
    select * from in_force where (usr, path) not in (
        select (usr, path) from views_seen where starts_with(path, '/store/home/')
        union all
        select (usr, path || '0') from views_seen where starts_with(path, '/store/home/'))
    """,
    views=("in_force", "views_seen"),
)
def unshare_many(spark, sf_dir):
    asked = fx.views_seen(spark, sf_dir).select(
        "usr", F.array("path", F.concat("path", F.lit("0"))).alias("paths")
    )
    return grants.unshare_many(_in_force(spark, sf_dir), asked, fx.HOME)


@query(
    """
    select * from in_force where (usr, path) not in (
        select (usr + step, path) from views_seen, (values (0), (1), (2)) steps(step)
        where starts_with(path, '/store/home/'))
    """,
    views=("in_force", "views_seen"),
)
def unshare_users(spark, sf_dir):
    users = F.array("usr", F.col("usr") + 1, F.col("usr") + 2)
    asked = fx.views_seen(spark, sf_dir).select("path", users.alias("users"))
    return grants.unshare_users(_in_force(spark, sf_dir), asked, fx.HOME)


@query(
    """
    select usr, part, '{"sharing":[{"user":"' || usr || '","paths":['
           || string_agg('{"path":"' || path || '","permission":"' || permission || '"}', ',' order by path)
           || ']}]}' as payload
    from (select *, (row_number() over (partition by usr order by path) - 1) // 15 as part from in_force)
    group by usr, part
    """,
    views=("in_force",),
)
def share_payload(spark, sf_dir):
    return grants.share_payloads(_in_force(spark, sf_dir), page_size=15)


@query(
    """
    select usr, part, '{"unshare":[{"user":"' || usr || '","paths":['
           || string_agg('"' || path || '"', ',' order by path) || ']}]}' as payload
    from (select *, (row_number() over (partition by usr order by path) - 1) // 15 as part
          from (select distinct usr, path from views_seen))
    group by usr, part
    """,
    views=("views_seen",),
)
def unshare_payload(spark, sf_dir):
    return grants.unshare_payloads(fx.views_seen(spark, sf_dir), page_size=15)


@query("select cast(usr as varchar) as usr, path, permission from in_force", views=("in_force",))
def read_share_payloads(spark, sf_dir):
    posted = grants.share_payloads(_in_force(spark, sf_dir), page_size=15)
    log = posted.select(F.col("part").alias("rid"), F.col("payload").alias("body"))
    return responses.share_rows(log).select("usr", "path", "permission")


@query("select distinct cast(usr as varchar) as usr, path from views_seen", views=("views_seen",))
def read_unshare_payloads(spark, sf_dir):
    posted = grants.unshare_payloads(fx.views_seen(spark, sf_dir), page_size=15)
    log = posted.select(F.col("part").alias("rid"), F.col("payload").alias("body"))
    return responses.unshare_rows(log).select("usr", "path")
