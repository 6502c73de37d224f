"""Rows out of logged JSON bodies, read with fixed schemas.

Each function takes a column ``body`` and keeps ``rid``.  A body without the key
in question gives no rows; ``reports.require_keys`` tells such bodies apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.avus import IRODS, STANDARD
from shelfmark.operators.listing import with_path_parts

_ENTRY = "id: string, path: string, label: string, md5: string"
_INFO = "id: string, type: string, label: string, md5: string"
_AVU = "attr: string, value: string, unit: string"


def _parse(schema: str) -> Column:
    return F.from_json("body", schema)


def _or_empty(array: Column, like: str) -> Column:
    return F.coalesce(array, F.array().cast(f"array<struct<{like}>>"))


def listing_rows(log: DataFrame) -> DataFrame:
    """Catalog rows of ``{"files": [...], "folders": [...]}``."""
    parsed = log.withColumn("_dir", _parse(f"files array<struct<{_ENTRY}>>, folders array<struct<{_ENTRY}>>"))

    def entries(key: str, kind: str) -> Column:
        listed = _or_empty(F.col(f"_dir.{key}"), _ENTRY)
        return F.transform(listed, lambda e: F.struct(F.lit(kind).alias("type"), e["id"].alias("id"),
                                                      e["path"].alias("path"), e["label"].alias("label"), e["md5"].alias("md5")))

    both = F.concat(entries("files", "file"), entries("folders", "dir"))
    return parsed.select("rid", F.inline(both))


def stat_rows(log: DataFrame) -> DataFrame:
    """Catalog rows of ``{"paths": {path: info}}``; a path without info is left out."""
    parsed = log.select("rid", F.explode(_parse(f"paths map<string, struct<{_INFO}>>")["paths"]).alias("path", "_info"))
    rows = parsed.filter(F.col("_info").isNotNull()).select("rid", "path", "_info.*")
    return with_path_parts(rows.drop("label"))


def existence_rows(log: DataFrame) -> DataFrame:
    """``rid, path, exists`` of ``{"paths": {path: bool}}``."""
    parsed = _parse("paths map<string, boolean>")["paths"]
    return log.select("rid", F.explode(parsed).alias("path", "exists"))


def user_rows(log: DataFrame) -> DataFrame:
    """``rid, username, info`` of ``{username: info}``, the info as a string map."""
    parsed = F.from_json("body", "map<string, map<string, string>>")
    return log.select("rid", F.explode(parsed).alias("username", "info"))


def tag_rows(log: DataFrame) -> DataFrame:
    """Tag rows of ``{"avus": [...], "irods-avus": [...]}``."""
    parsed = log.withColumn("_tags", _parse(f"`{STANDARD}` array<struct<{_AVU}>>, `{IRODS}` array<struct<{_AVU}>>"))

    def tags(ns: str) -> Column:
        listed = _or_empty(F.col("_tags")[ns], _AVU)
        return F.transform(listed, lambda t: F.struct(F.lit(ns).alias("ns"), t["attr"].alias("attr"),
                                                      t["value"].alias("value"), t["unit"].alias("unit")))

    return parsed.select("rid", F.inline(F.concat(tags(STANDARD), tags(IRODS))))


def share_rows(log: DataFrame) -> DataFrame:
    """Grant rows of ``{"sharing": [{"user", "paths": [{"path", "permission"}]}]}``."""
    schema = "sharing array<struct<user: string, paths: array<struct<path: string, permission: string>>>>"
    users = log.select("rid", F.inline(_parse(schema)["sharing"]))
    return users.select("rid", F.col("user").alias("usr"), F.inline("paths"))


def unshare_rows(log: DataFrame) -> DataFrame:
    """``rid, usr, path`` rows of ``{"unshare": [{"user", "paths": [path]}]}``."""
    users = log.select("rid", F.inline(_parse("unshare array<struct<user: string, paths: array<string>>>")["unshare"]))
    return users.select("rid", F.col("user").alias("usr"), F.explode("paths").alias("path"))
