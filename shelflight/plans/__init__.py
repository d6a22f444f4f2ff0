"""Registered queries: every operator bound to the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from shelflight.plans import charts, cleaning, clusters, collection, extract, ingest, models, reports, similar, views

    modules = (ingest, extract, collection, cleaning, reports, charts, views, models, clusters, similar)
    return {name: query for m in modules for name, query in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    from shelflight.plans import charts, cleaning, clusters, collection, extract, ingest, models, reports, similar, views

    modules = (ingest, extract, collection, cleaning, reports, charts, views, models, clusters, similar)
    return {name: sql for m in modules for name, sql in m.SQL.items()}
