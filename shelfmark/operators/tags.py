"""Attribute-value-unit tags as rows ``id, ns, attr, value, unit``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.avus import IRODS, STANDARD, parse_avu, render_avu
from shelfmark.operators.ranks import RANGE_ROWS, pages_within

TAG_COLUMNS = ("id", "ns", "attr", "value", "unit")


def parse_tags(specs: DataFrame) -> DataFrame:
    """``id, ns, spec`` rows to tag rows; ``rejected`` marks a spec without ``=``."""
    parsed = specs.withColumn("_avu", parse_avu(F.col("spec")))
    return parsed.select("id", "ns", "_avu.*", F.col("_avu.value").isNull().alias("rejected"))


def valid_tags(specs: DataFrame) -> DataFrame:
    return parse_tags(specs).filter(~F.col("rejected")).select(*TAG_COLUMNS)


def rejected_posts(specs: DataFrame) -> DataFrame:
    """``id, n_rejected`` of the posts that hold a malformed spec."""
    counted = parse_tags(specs).groupBy("id").agg(F.count_if("rejected").alias("n_rejected"))
    return counted.filter("n_rejected > 0")


def post_tags(current: DataFrame, specs: DataFrame, strict: bool = False) -> DataFrame:
    """Tags after posting the specs of each id, which replace all it had.

    One malformed spec rejects the whole post of its id, which then keeps its
    tags; ``strict`` fails the job instead.
    """
    parsed = parse_tags(specs)
    if strict:
        malformed = F.raise_error(F.concat(F.lit("malformed tag of "), F.coalesce("id", F.lit("null"))))
        return overwrite_tags(current, parsed.filter(F.when(F.col("rejected"), malformed.cast("boolean")).otherwise(True)))
    bad = parsed.filter("rejected").select("id").distinct()
    return overwrite_tags(current, parsed.join(bad, "id", "left_anti").select(*TAG_COLUMNS))


def overwrite_tags(current: DataFrame, incoming: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Tags after posting ``incoming``: a posted id loses all it had, in both namespaces.

    ``ids`` names the posted ids when some were posted without any tag.
    """
    posted = (incoming if ids is None else ids).select("id").distinct()
    kept = current.join(posted, "id", "left_anti")
    return kept.select(*TAG_COLUMNS).unionByName(incoming.select(*TAG_COLUMNS))


def get_tags(tags: DataFrame, ids: DataFrame, irods: bool = False) -> DataFrame:
    """Tags of the asked ids in one namespace."""
    wanted = tags.filter(F.col("ns") == (IRODS if irods else STANDARD))
    return wanted.join(ids.select("id").distinct(), "id", "left_semi").select(*TAG_COLUMNS)


def render_tags(
    tags: DataFrame, page_size: int = 1000, slice_rows: int = RANGE_ROWS
) -> DataFrame:
    """``attr=value`` lines per id and namespace, ``page_size`` lines to a row."""
    lines = tags.select("id", "ns", render_avu(F.col("attr"), F.col("value")).alias("line"))
    paged = pages_within(lines, ["id", "ns"], ["line"], page_size, range_rows=slice_rows)
    text = F.array_join(F.sort_array(F.collect_list("line")), "\n")
    return paged.groupBy("id", "ns", "page").agg(text.alias("tags"))


def tag_payloads(tags: DataFrame) -> DataFrame:
    """The JSON body that posts the tags of an id: both namespaces, either may be empty.

    Posting replaces all tags of an id, so an id has exactly one body.
    """

    def avus(ns: str) -> Column:
        tag = F.when(F.col("ns") == ns, F.struct("attr", "value", "unit"))
        return F.sort_array(F.collect_list(tag)).alias(ns)

    return (
        tags.groupBy("id")
        .agg(avus(STANDARD), avus(IRODS))
        .select("id", F.to_json(F.struct(STANDARD, F.col(f"`{IRODS}`"))).alias("payload"))
    )


def has_tag(tags: DataFrame, attr: str, value: str) -> DataFrame:
    """Ids that carry the tag, with their tag counts per namespace."""
    hit = (F.col("attr") == attr) & (F.col("value") == value)
    return (
        tags.groupBy("id")
        .agg(
            F.max(hit).alias("_hit"),
            F.count_if(F.col("ns") == STANDARD).alias("n_avus"),
            F.count_if(F.col("ns") == IRODS).alias("n_irods_avus"),
        )
        .filter("_hit")
        .drop("_hit")
    )
