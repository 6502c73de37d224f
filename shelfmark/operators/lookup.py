"""Looking up many paths or users in one join.

Left and anti joins keep the requests on the side AQE can split, so a path that
a third of all requests ask for is no single task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.paths import normalize_path


def stat_paths(requests: DataFrame, objects: DataFrame, strict: bool = False) -> DataFrame:
    """The catalog row of each requested path and whether there is one.

    ``strict`` fails the job on the first missing path instead of flagging it.
    """
    info = objects.select(
        F.col("path").alias("found_path"), "label", "type", "id", "md5", "size"
    )
    joined = requests.join(info, normalize_path(F.col("path")) == F.col("found_path"), "left")
    found = F.col("found_path").isNotNull()
    if strict:
        missing = F.raise_error(F.concat(F.lit("no such path: "), F.coalesce("path", F.lit("null"))))
        found = F.when(found, F.lit(True)).otherwise(missing.cast("boolean"))
    return joined.withColumn("found", found).drop("found_path")


def _with_type(requests: DataFrame, objects: DataFrame) -> DataFrame:
    types = objects.select(F.col("path").alias("_path"), F.col("type").alias("_type"))
    return requests.join(types, normalize_path(F.col("path")) == F.col("_path"), "left")


def paths_exist(requests: DataFrame, objects: DataFrame) -> DataFrame:
    joined = _with_type(requests, objects)
    return joined.withColumn("exists", F.col("_path").isNotNull()).drop("_path", "_type")


def type_exists(requests: DataFrame, objects: DataFrame, kind: str) -> DataFrame:
    """Like ``paths_exist``, and the entry must be of ``kind``."""
    if kind not in ("dir", "file"):
        raise ValueError("type must be 'dir' or 'file'")
    joined = _with_type(requests, objects)
    hit = F.coalesce(F.col("_type") == kind, F.lit(False))
    return joined.withColumn("exists", hit).drop("_path", "_type")


def exists_by_type(requests: DataFrame, objects: DataFrame, want: str = "want") -> DataFrame:
    """Each request names the type it wants, or null for any.

    ``result`` is ``yes``, ``no``, or ``bad_type`` for an unsupported type.
    """
    kind = F.col(want)
    hit = F.when(kind.isNull(), F.col("_path").isNotNull()).otherwise(
        F.coalesce(F.col("_type") == kind, F.lit(False))
    )
    result = (
        F.when(kind.isNotNull() & ~kind.isin("dir", "file"), F.lit("bad_type"))
        .when(hit, F.lit("yes"))
        .otherwise(F.lit("no"))
    )
    return _with_type(requests, objects).withColumn("result", result).drop("_path", "_type")


def lookup_users(requests: DataFrame, users: DataFrame, on: str = "username") -> DataFrame:
    """Profile columns per requested name, with ``found``."""
    profiles = users.withColumn("_found", F.lit(True))
    return (
        requests.join(profiles, on, "left")
        .withColumn("found", F.coalesce("_found", F.lit(False)))
        .drop("_found")
    )


class Resolved(NamedTuple):
    """Answers without repetition: what each request stands for, and the files of each target once.

    A thousand requests for one directory of twenty thousand files are a
    thousand targets and twenty thousand files, not twenty million rows.
    """

    targets: DataFrame
    files: DataFrame

    def expanded(self, rid: str = "rid") -> DataFrame:
        """One row per request and file, as ``resolve_requests`` gives."""
        ok = self.targets.filter("status = 'ok'").join(self.files, "target")
        missing = self.targets.filter("status = 'missing'").withColumn("file", F.lit(None).cast("string"))
        columns = [rid, "target", "file", "status"]
        return ok.select(*columns).unionByName(missing.select(*columns))


def resolve_targets(requests: DataFrame, objects: DataFrame, rid: str = "rid") -> Resolved:
    """``targets(rid, target, type, status)`` and ``files(target, file)`` of the distinct targets.

    The file of a file target is itself, those of a directory lie directly in it.
    A target of a request that does not exist is ``missing`` and has no files.
    """
    asked = requests.select(rid, normalize_path(F.col("path")).alias("target"))
    distinct = asked.select("target").distinct()
    known = objects.select(F.col("path").alias("_path"), "type")
    targets = asked.join(known, F.col("target") == F.col("_path"), "left").select(
        rid, "target", "type", F.when(F.col("_path").isNull(), F.lit("missing")).otherwise(F.lit("ok")).alias("status")
    )
    files = objects.filter(F.col("type") == "file")
    keyed = files.select(F.explode(F.array("path", "parent")).alias("target"), F.col("path").alias("file"))
    return Resolved(targets, keyed.join(distinct, "target", "left_semi"))


def resolve_requests(requests: DataFrame, objects: DataFrame, rid: str = "rid") -> DataFrame:
    """The files each request stands for.

    A file resolves to itself, a directory to the files directly in it, and a
    path that does not exist to one row with status ``missing``.  An empty
    directory gives no row.  The inner join serves both kinds at once: every
    file is keyed by its own path and by its parent.
    """
    asked = requests.select(rid, normalize_path(F.col("path")).alias("target"))
    files = objects.filter(F.col("type") == "file")
    keyed = files.select(
        F.explode(F.array("path", "parent")).alias("target"), F.col("path").alias("file")
    )
    found = asked.join(keyed, "target").select(rid, "target", "file", F.lit("ok").alias("status"))
    known = objects.select(F.col("path").alias("target"))
    missing = asked.join(known, "target", "left_anti").select(
        rid, "target", F.lit(None).cast("string").alias("file"), F.lit("missing").alias("status")
    )
    return found.unionByName(missing)
