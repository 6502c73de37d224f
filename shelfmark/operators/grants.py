"""Sharing grants as rows ``usr, path, permission``, one per user and path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.paths import under_home
from shelfmark.operators.ranks import RANGE_ROWS, pages_within

GRANT_KEY = ["usr", "path"]


def valid_permission(permission: Column) -> Column:
    return F.coalesce(permission.isin("read", "write"), F.lit(False))


def check_grants(grants: DataFrame, home: str) -> DataFrame:
    """Flag each ``usr, path, permission`` row: ``home_ok``, ``permission_ok``."""
    return grants.withColumn("home_ok", under_home(F.col("path"), home)).withColumn(
        "permission_ok", valid_permission(F.col("permission"))
    )


def share(
    current: DataFrame, changes: DataFrame, home: str, order: str = "seq", strict: bool = False
) -> DataFrame:
    """Grants after sharing: the last valid change of a user and path sets its permission.

    Invalid changes are left out, and ``check_grants`` shows which those are;
    ``strict`` fails the job on one instead.
    """
    valid = changes.filter(_or_fail(under_home(F.col("path"), home) & valid_permission(F.col("permission")), strict))
    before = F.lit(None).cast(changes.schema[order].dataType)
    # Stacked and folded rather than joined: one shuffle, combined before it.
    # Nulls order first, so any change comes after what was there.
    stacked = current.select(*GRANT_KEY, "permission", before.alias("_seq")).unionByName(
        valid.select(*GRANT_KEY, "permission", F.col(order).alias("_seq"))
    )
    last = F.max_by("permission", F.struct(F.col("_seq").isNotNull(), "_seq"))
    return stacked.groupBy(*GRANT_KEY).agg(last.alias("permission"))


def check_share_requests(requests: DataFrame, home: str) -> DataFrame:
    """Add ``ok``: one bad pair in ``paths`` rejects the whole request.

    ``paths`` is an array of ``path, permission`` structs, checked in place, so
    no row has to be exploded and grouped back.
    """
    return requests.withColumn(
        "ok",
        F.coalesce(
            F.forall(
                "paths",
                lambda p: under_home(p["path"], home) & valid_permission(p["permission"]),
            ),
            F.lit(False),
        ),
    )


def _or_fail(valid: Column, strict: bool) -> Column:
    if not strict:
        return valid
    bad = F.raise_error(F.lit("a path is not below home, or a permission is neither read nor write"))
    return F.when(valid, F.lit(True)).otherwise(bad.cast("boolean"))


def share_many(
    current: DataFrame, requests: DataFrame, home: str, rid: str = "rid", strict: bool = False
) -> DataFrame:
    """Grants after applying every wholly valid request, in order of ``rid``; ``strict`` fails on any other."""
    accepted = check_share_requests(requests, home).filter(_or_fail(F.col("ok"), strict))
    pairs = accepted.select("usr", F.posexplode("paths").alias("_at", "_pair"), rid).select(
        "usr", "_pair.path", "_pair.permission", F.struct(rid, "_at").alias("_seq")
    )
    return share(current, pairs, home, "_seq")


def unshare(current: DataFrame, revoked: DataFrame, home: str) -> DataFrame:
    """Grants after removing each ``usr, path``, whatever its permission."""
    gone = revoked.filter(under_home(F.col("path"), home)).select(*GRANT_KEY).distinct()
    return current.join(gone, GRANT_KEY, "left_anti").select(*GRANT_KEY, "permission")


def check_unshare_requests(requests: DataFrame, home: str) -> DataFrame:
    return requests.withColumn(
        "ok",
        F.coalesce(F.forall("paths", lambda p: under_home(p, home)), F.lit(False)),
    )


def unshare_many(current: DataFrame, requests: DataFrame, home: str) -> DataFrame:
    """Apply requests of ``usr, paths``; a bad path rejects its whole request."""
    accepted = check_unshare_requests(requests, home).filter("ok")
    return unshare(current, accepted.select("usr", F.explode("paths").alias("path")), home)


def unshare_users(current: DataFrame, requests: DataFrame, home: str) -> DataFrame:
    """Apply requests of ``path, users``: one path taken from many users."""
    return unshare(current, requests.select(F.explode("users").alias("usr"), "path"), home)


def current_grants(log: DataFrame) -> DataFrame:
    """Fold a log of ``seq, ts, usr, path, action, permission`` into what is in force.

    The last action on a user and path decides; an ``unshare`` removes it.
    """
    last = log.groupBy(*GRANT_KEY).agg(last_action().alias("_last"))
    return last.filter(F.col("_last.action") == "share").select(
        *GRANT_KEY, F.col("_last.permission").alias("permission")
    )


def last_action() -> Column:
    return F.max_by(F.struct("action", "permission"), F.struct("ts", "seq"))


def share_payloads(
    grants: DataFrame, page_size: int = 1000, slice_rows: int = RANGE_ROWS
) -> DataFrame:
    """The JSON body that shares a user's grants, ``page_size`` paths to a body."""
    pair = F.struct("path", "permission")
    columns = [*GRANT_KEY, "permission"]
    return _payloads(grants.select(*columns), columns[1:], pair, "sharing", page_size, slice_rows)


def unshare_payloads(
    revoked: DataFrame, page_size: int = 1000, slice_rows: int = RANGE_ROWS
) -> DataFrame:
    """The JSON body that revokes a user's paths, ``page_size`` paths to a body."""
    pairs = revoked.select(*GRANT_KEY).distinct()
    return _payloads(pairs, ["path"], F.col("path"), "unshare", page_size, slice_rows)


def _payloads(
    rows: DataFrame, order: list[str], item: Column, key: str, page_size: int, slice_rows: int
) -> DataFrame:
    paged = pages_within(rows, ["usr"], order, page_size, into="part", range_rows=slice_rows)
    body = paged.groupBy("usr", "part").agg(F.sort_array(F.collect_list(item)).alias("paths"))
    entry = F.struct(F.col("usr").cast("string").alias("user"), "paths")
    return body.select("usr", "part", F.to_json(F.struct(F.array(entry).alias(key))).alias("payload"))
