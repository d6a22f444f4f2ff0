"""Bringing the offers of several shops into one shape, and reporting on it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.quantiles import join_groups
from shelflight.roles import Roles
from shelflight.session import settle, small_table


def union_sources(sources: Mapping[str, DataFrame], source_column: str = Roles().source) -> DataFrame:
    """All records under one schema, each tagged with its source; missing columns are NULL."""
    tagged = [df.withColumn(source_column, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def slug_table(spark: SparkSession, slugs: Mapping[str, Mapping[str, str]] = fixed.CATEGORY_SLUGS) -> DataFrame:
    """The ``(source, slug) -> category`` mapping in listing order."""
    rows = [(source, slug, category, i) for source, by_slug in slugs.items()
            for i, (slug, category) in enumerate(by_slug.items())]
    return small_table(spark, rows, "izvor string, slug string, kategorija string, redosled int")


def with_category(df: DataFrame, mapping: DataFrame, on: list[str]) -> DataFrame:
    """Attach the category of each listing; unknown listings get NULL.

    The mapping is written by hand, one line per listing, so Spark sees its size
    and broadcasts it.
    """
    return df.join(mapping, on, "left").select(*df.columns, *[c for c in mapping.columns if c not in on])


def with_price_only(df: DataFrame, price: str = Roles().price) -> DataFrame:
    return df.where(F.col(price).isNotNull() & (F.col(price) != 0))


def discovery(pages: DataFrame, category: str, items: Column) -> DataFrame:
    """Items found on the pages of each category, and whether any were."""
    found = pages.groupBy(category).agg(F.sum(F.coalesce(items, F.lit(0))).alias("broj"))
    return found.select(category, "broj", F.when(F.col("broj") > 0, "OK").otherwise("PRAZNO").alias("status"))


def collection_summary(records: DataFrame, source: str, page: str, stored: Column, category: str | None = None,
                       listing: str | None = None, span: int = 1000) -> DataFrame:
    """Stored and seen records per source, category and page, with a running total over the pages of a source.

    Categories come in the order of ``listing``, a number; those without one come last, in one order by their pages,
    and rows of one page there have the same running total.  A missing source, category or page is a group like any
    other, and missing pages come last.  The running total is built in two steps, inside spans of ``span`` pages of a
    place in the listing and across the spans, so no single window holds all pages of a large source.
    """
    named = [c for c in (category, listing) if c]
    order = [listing] if listing else []
    last = [F.col(c).asc_nulls_last() for c in (*order, "_span")]
    per_page = (records.groupBy(source, *named, page)
                .agg(F.count(F.lit(1)).alias("vidjeno"), F.count_if(stored).alias("upisano"))
                .withColumn("_span", F.floor(F.col(page) / span)))
    inside = F.sum("upisano").over(Window.partitionBy(source, *order, "_span").orderBy(page))
    span_end = Window.partitionBy(source).orderBy(*last).rowsBetween(Window.unboundedPreceding, -1)
    spans = (per_page.groupBy(source, *order, "_span").agg(F.sum("upisano").alias("_total"))
             .select(source, *order, "_span", F.coalesce(F.sum("_total").over(span_end), F.lit(0)).alias("_before")))
    # One row per span, stored so that Spark sees how small it is.
    return (join_groups(per_page.withColumn("_inside", inside), settle(spans, "spans"), [source, *order, "_span"])
            .select(source, *named, page, "upisano", "vidjeno", (F.col("_before") + F.col("_inside")).alias("ukupno")))


def source_totals(records: DataFrame, source: str, stored: Column) -> DataFrame:
    return records.groupBy(source).agg(F.count_if(stored).alias("upisano"))
