"""Reading logged store responses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values: (endpoint, status, error_code or None for any) -> outcome.
# Endpoints absent here fall through to http_error / ok.
OUTCOMES = (
    ("stat", 500, "ERR_DOES_NOT_EXIST", "not_found"),
    ("stat", 400, None, "bad_request"),
    ("list", 500, "ERR_DOES_NOT_EXIST", "invalid_path"),
    ("upload", 500, "ERR_EXISTS", "skipped"),
    ("download", 500, "ERR_REQUEST_FAILED", "invalid_path"),
    ("token", 400, None, "unauthorized"),
)


def response_outcome(endpoint: Column, status: Column, body: Column) -> Column:
    code = F.get_json_object(body, "$.error_code")
    outcome = F
    for name, number, error, result in OUTCOMES:
        hit = (endpoint == name) & (status == number)
        if error is not None:
            hit = hit & (code == error)
        outcome = outcome.when(hit, F.lit(result))
    outcome = outcome.when((endpoint == "token") & (status != 200), F.lit("bad_response"))
    outcome = outcome.when(status.isNull(), F.lit("bad_response"))
    return outcome.when(status >= 400, F.lit("http_error")).otherwise(F.lit("ok"))


def has_keys(body: Column, keys: Sequence[str], nulls_count: bool = True) -> Column:
    """All ``keys`` are present at the top level; ``nulls_count`` says whether null will do."""
    if not nulls_count:
        found = [F.get_json_object(body, f"$['{key}']").isNotNull() for key in keys]
        return reduce(and_, found, F.lit(True))
    present = F.json_object_keys(body)
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.coalesce(F.size(F.array_except(wanted, present)) == 0, F.lit(False))


def path_entry(body: Column, path: Column, value_type: T.DataType) -> Column:
    """``body.paths[path]``; null when the map or the entry is absent."""
    schema = T.StructType([T.StructField("paths", T.MapType(T.StringType(), value_type))])
    return F.try_element_at(F.from_json(body, schema)["paths"], path)
