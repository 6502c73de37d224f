"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans.fixtures import with_views

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, views: tuple[str, ...] = (), name: str | None = None):
    """Register the decorated ``(spark, sf_dir)`` function under its name.

    ``sql`` is the oracle; ``views`` are the derived views it selects from.
    """

    def register(run: Runner) -> Runner:
        text = None if sql is None else with_views(views, sql)
        QUERIES[name or run.__name__] = Query(run, text)
        return run

    return register
