"""The ten named reports over the clean catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.roles import Roles

N = "broj_proizvoda"


def money(column: str) -> Column:
    """Price as an exact number, so that rounding does not depend on binary fractions."""
    return F.col(column).cast("decimal(12,2)")


def mean(column: str, digits: int) -> Column:
    """Average of exact prices, rounded half away from zero."""
    total = F.sum(money(column))
    return F.round(total / F.count(column).cast("decimal(20,0)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    exact = F.lit(100).cast("decimal(3,0)") * part.cast("decimal(18,0)") / whole.cast("decimal(18,0)")
    return F.round(exact, digits).cast("double")


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(N))


def count_per_category(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    return count_by(df, r.category).orderBy(F.desc(N), r.category)


def top_brands(df: DataFrame, r: Roles = Roles(), n: int = 10) -> DataFrame:
    return count_by(df, r.brand).orderBy(F.desc(N), r.brand).limit(n)


def count_grade_at_least(df: DataFrame, r: Roles = Roles(), code: int = 5) -> DataFrame:
    return df.where(F.col(r.grade_code) >= code).agg(F.count(F.lit(1)).alias(N))


def count_price_up_to(df: DataFrame, r: Roles = Roles(), price: float = 50_000) -> DataFrame:
    return df.where(F.col(r.price) <= price).agg(F.count(F.lit(1)).alias(N))


def dearest_of_category(df: DataFrame, r: Roles = Roles(), category: str = "televizor", n: int = 30) -> DataFrame:
    chosen = df.where(F.col(r.category) == category).orderBy(F.desc(r.price), r.id).limit(n)
    return chosen.select(r.name, r.brand, r.price, r.diagonal, r.grade)


def price_stats(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    return df.groupBy(r.category).agg(
        F.count(F.lit(1)).alias(N), mean(r.price, 2).alias("prosecna_cena"),
        F.min(r.price).alias("min_cena"), F.max(r.price).alias("max_cena"),
        F.round(F.stddev_samp(r.price), 2).alias("std_cena"),
    ).orderBy(F.desc("prosecna_cena"), r.category)


def grade_share(df: DataFrame, r: Roles = Roles(), code: int = 7) -> DataFrame:
    good = F.count_if(F.col(r.grade_code) >= code)
    return df.where(F.col(r.grade_code).isNotNull()).groupBy(r.category).agg(
        F.count(F.lit(1)).alias("ukupno"), good.alias("klasa_a_ili_bolja"),
        percent(good, F.count(F.lit(1))).alias("procenat_klasa_a"),
    ).orderBy(F.desc("procenat_klasa_a"), r.category)


def dearest_brands(df: DataFrame, r: Roles = Roles(), least: int = 20, n: int = 10) -> DataFrame:
    stats = df.groupBy(r.brand).agg(
        F.count(F.lit(1)).alias(N), mean(r.price, 0).alias("prosecna_cena"),
        F.round(F.min(money(r.price)), 0).cast("double").alias("min_cena"),
        F.round(F.max(money(r.price)), 0).cast("double").alias("max_cena"))
    return stats.where(F.col(N) >= least).orderBy(F.desc("prosecna_cena"), r.brand).limit(n)


def stock_share(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    inside = F.count_if(F.col(r.in_stock))
    return df.where(F.col(r.in_stock).isNotNull()).groupBy(r.category).agg(
        F.count(F.lit(1)).alias("ukupno"), inside.alias("na_lageru"),
        F.count_if(~F.col(r.in_stock)).alias("nije_na_lageru"),
        percent(inside, F.count(F.lit(1))).alias("procenat_na_lageru"),
    ).orderBy(F.desc("procenat_na_lageru"), r.category)


def by_size(df: DataFrame, r: Roles = Roles(), category: str = "frizider",
            small: float = 200, medium: float = 400) -> DataFrame:
    volume = F.col(r.volume)
    size = (F.when(volume < small, fixed.SIZE_SMALL).when(volume <= medium, fixed.SIZE_MEDIUM)
            .otherwise(fixed.SIZE_LARGE))
    sized = df.where((F.col(r.category) == category) & volume.isNotNull()).groupBy(size.alias("velicina")).agg(
        F.count(F.lit(1)).alias(N), mean(r.price, 0).alias("prosecna_cena"), F.min(volume).alias("_least"))
    return sized.orderBy("_least").drop("_least")


REPORTS: dict[str, Callable[..., DataFrame]] = dict(zip(fixed.REPORT_NAMES, [
    count_per_category, top_brands, count_grade_at_least, count_price_up_to, dearest_of_category,
    price_stats, grade_share, dearest_brands, stock_share, by_size,
], strict=True))


def report_bundle(df: DataFrame, roles: Roles = Roles(), **options: dict) -> dict[str, DataFrame]:
    """Every report by name, lazily; ``options`` holds arguments for single reports."""
    return {name: report(df, roles, **options.get(name, {})) for name, report in REPORTS.items()}


def save_reports(reports: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write each report below ``folder`` under its own name; the row counts by name."""
    counts = {}
    for name, report in reports.items():
        path = f"{folder.rstrip('/')}/{name}"
        report.write.mode("overwrite").parquet(path)
        counts[name] = report.sparkSession.read.parquet(path).count()
    return counts
