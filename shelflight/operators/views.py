"""Parameterised views: overview, browsing, sorting, examples, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight.functions.text import to_number
from shelflight.operators.charts import value_counts
from shelflight.roles import Roles


def overview(df: DataFrame, r: Roles = Roles(), exact: bool = True) -> DataFrame:
    """Rows, categories, brands, price range and the share with a grade, in one row.

    ``exact=False`` counts distinct values by sketch, in a single pass.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("ukupno"), distinct(F.col(r.category)).alias("kategorija"),
        distinct(F.col(r.brand)).alias("brendova"), F.min(r.price).alias("min_cena"),
        F.max(r.price).alias("max_cena"),
        F.coalesce(F.avg(F.col(r.grade_code).isNotNull().cast("int")) * 100, F.lit(0.0)).alias("procenat_sa_klasom"))


def overview_parts(df: DataFrame, load: str, r: Roles = Roles(), bits: int = 14) -> DataFrame:
    """What ``overview`` needs of each load, one row per value of ``load``, to be stored and merged later.

    Distinct values are HLL sketches of ``2**bits`` places, a bounded size whatever the load holds: their counts are
    exact while values are few, and off by about ``1.04 / sqrt(2**bits)`` beyond.  A missing load is one of its own.
    """
    return df.groupBy(F.col(load).alias("ucitavanje")).agg(
        F.count(F.lit(1)).alias("redova"), F.count(r.grade_code).alias("sa_klasom"),
        F.hll_sketch_agg(F.col(r.category), bits).alias("kategorije"), F.hll_sketch_agg(F.col(r.brand), bits).alias("brendovi"),
        F.min(r.price).alias("min_cena"), F.max(r.price).alias("max_cena"))


def overview_of_parts(parts: DataFrame) -> DataFrame:
    """``overview`` of all loads from their stored parts; the rows of the loads are not read again."""
    def merged(sketch: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0).cast("long"))

    share = F.lit(100.0) * F.sum("sa_klasom") / F.sum("redova")
    return parts.agg(
        F.coalesce(F.sum("redova"), F.lit(0).cast("long")).alias("ukupno"), merged("kategorije").alias("kategorija"),
        merged("brendovi").alias("brendova"), F.min("min_cena").alias("min_cena"), F.max("max_cena").alias("max_cena"),
        F.coalesce(share, F.lit(0.0)).alias("procenat_sa_klasom"))


def largest_categories(df: DataFrame, r: Roles = Roles(), n: int = 15) -> DataFrame:
    """The ``n`` largest categories, smallest of them first."""
    return value_counts(df, r.category, n).orderBy("broj", F.desc(r.category))


def browse(df: DataFrame, r: Roles = Roles(), category: str | None = None, n: int = 500) -> tuple[DataFrame, DataFrame]:
    """The ``n`` dearest items, of one category if given, and the count of all that match."""
    chosen = df if category is None else df.where(F.col(r.category) == category)
    shown = chosen.orderBy(F.col(r.price).desc_nulls_last(), r.id).limit(n)
    return shown.select(r.id, r.name, r.brand, r.category, r.price), chosen.agg(F.count(F.lit(1)).alias("zapisa"))


def sort_key(df: DataFrame, column: str, numeric: bool) -> Column:
    """Numbers by value with anything else below all of them; texts without regard to case."""
    if not numeric:
        return F.lower(F.col(column).cast("string"))
    text = F.trim(F.regexp_replace(F.col(column).cast("string"), ",|RSD", ""))
    return F.coalesce(to_number(text), F.lit(float("-inf")))


def sort_view(df: DataFrame, column: str, numeric: bool, descending: bool = False, r: Roles = Roles()) -> DataFrame:
    key = sort_key(df, column, numeric)
    return df.orderBy(key.desc() if descending else key.asc(), r.id)


def category_list(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    return df.select(r.category).where(F.col(r.category).isNotNull()).distinct().orderBy(r.category)


def first_examples(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    """Per category the first value of every column, in id order, skipping missing ones."""
    priced = df.where(F.col(r.price).isNotNull() & F.col(r.category).isNotNull())
    others = [c for c in df.columns if c not in (r.category, r.id)]
    return priced.groupBy(r.category).agg(
        F.min(r.id).alias(r.id),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(r.id))).alias(c) for c in others]).orderBy(r.category)


def by_id(df: DataFrame, id, r: Roles = Roles()) -> DataFrame:
    """The item with the id; a ``ValueError`` when there is none."""
    found = df.where(F.col(r.id) == id)
    if found.isEmpty():
        raise ValueError(f"no item has {r.id}={id}")
    return found
