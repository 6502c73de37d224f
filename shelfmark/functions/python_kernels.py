"""The two operations that need Python: both run as Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def _without_null_keys(value):
    if not isinstance(value, dict):
        return value
    return {k: _without_null_keys(v) for k, v in value.items() if v is not None}


def _strip(text):
    try:
        parsed = json.loads(text, parse_constant=_no_constant)
        stripped = json.dumps(_without_null_keys(parsed), separators=(",", ":"), ensure_ascii=False, allow_nan=False)
        stripped.encode()
    except (TypeError, ValueError, RecursionError):  # a lone surrogate is a ValueError too
        return None
    return stripped


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def strip_null_keys(document: Column) -> Column:
    """Drop null-valued keys of a JSON object, through nested objects only.

    Lists and what they hold are left alone, emptied objects are kept, and text
    that is not JSON, nests too deeply, or holds a lone surrogate or a number beyond
    a double gives null.  ``to_json`` cannot do this: it also drops
    nulls inside arrays and needs a schema.
    """

    @F.pandas_udf(T.StringType())
    def kernel(documents: pd.Series) -> pd.Series:
        return documents.map(_strip)

    return kernel(document)


def star_map(
    df: DataFrame,
    func: Callable,
    arguments: Sequence[str],
    into: str,
    returns: T.DataType,
    chunksize: int | None = None,
) -> DataFrame:
    """Call ``func(*arguments)`` for every row, in parallel over partitions.

    ``chunksize`` rows are turned into Python objects at a time; by default a
    whole Arrow batch is.  Row order within a partition is kept; carry an
    ordinal column where the overall order matters.
    """
    if chunksize is not None and chunksize < 1:
        raise ValueError(f"chunksize must be 1 or more, not {chunksize}")
    names = list(arguments)
    result_type = to_arrow_type(returns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            step = chunksize or batch.num_rows or 1
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                columns = [part.column(name).to_pylist() for name in names]
                results.extend(func(*row) for row in zip(*columns))
            yield batch.append_column(into, pa.array(results, result_type))

    schema = T.StructType([*df.schema.fields, T.StructField(into, returns)])
    return df.mapInArrow(run, schema)
