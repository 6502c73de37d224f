"""Attribute-value-unit tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Namespaces, in the order they take in a payload.
STANDARD, IRODS = "avus", "irods-avus"

_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def parse_avu(spec: Column) -> Column:
    """``attr=value`` as a struct; null value when there is no ``=``.

    Anything after a second ``=`` is dropped and the unit is always empty.
    """
    parts = F.split(F.regexp_replace(spec, _OUTER_SPACE, ""), "=")
    return F.struct(
        F.get(parts, F.lit(0)).alias("attr"),
        F.get(parts, F.lit(1)).alias("value"),
        F.lit("").alias("unit"),
    )


def render_avu(attr: Column, value: Column) -> Column:
    return F.concat(attr, F.lit("="), value)
