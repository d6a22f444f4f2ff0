"""Cleaning and conforming of offers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import ordinal_code
from shelflight.functions.quantiles import join_groups, quantiles
from shelflight.functions.text import normal_brand
from shelflight.roles import Roles, nan_to_null
from shelflight.session import settle, small_table


@dataclass(frozen=True)
class CleanRules:
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(fixed.TECHNICAL_RANGES))
    min_filled: int = fixed.MIN_OPTIONAL_FILLED
    min_price: float = fixed.MIN_PRICE
    min_rows: int = fixed.MIN_CLEAN_ROWS
    grades: Sequence[str] = tuple(fixed.ENERGY_CLASSES)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where((F.col(column) > 0) & ~F.isnan(F.col(column).cast("double")))


def with_normal_brand(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, normal_brand(F.col(column).cast("string")))


def clamp_to_null(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Blank out values outside their range; the row stays."""
    return df.withColumns({c: F.when(F.col(c).between(lo, hi), F.col(c))
                           for c, (lo, hi) in ranges.items() if c in df.columns})


def filled_count(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns], F.lit(0))


def min_filled(df: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    return df.where(filled_count(columns) >= least)


def keep_latest(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """The last row per key; ``order`` ends with a unique column so that ties are settled.

    A missing value sorts last, so it wins.
    The rank filter is applied before the shuffle too, so a key that holds a
    large part of the table sends one row per input partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    last_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    return df.withColumn("_rank", F.row_number().over(last_first)).where("_rank = 1").drop("_rank")


def tukey_filter(df: DataFrame, column: str, floor: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Keep values within 1.5 interquartile ranges of the quartiles, not below ``floor``."""
    bounds = quantiles(df, column, [0.25, 0.75], by).select(*by, "q")
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    low = F.greatest(low, F.lit(float(floor))) if floor is not None else low
    x = F.col(column)
    if by:
        return (join_groups(df, settle(bounds.select(*by, low.alias("_low"), high.alias("_high")), "bounds"), by)
                .where((x >= F.col("_low")) & (x <= F.col("_high"))).drop("_low", "_high"))
    edges = bounds.select(low.alias("low"), high.alias("high")).first()
    if edges["high"] is None:
        return df
    return df.where((x >= edges["low"]) & (x <= edges["high"]))


def clean(df: DataFrame, roles: Roles = Roles(), rules: CleanRules = CleanRules()) -> DataFrame:
    """Required fields, positive price, brand, ranges, filled columns, latest per url, outliers, grade code."""
    latest = (nan_to_null(df)
              .transform(require, roles.required)
              .transform(positive, roles.price)
              .transform(with_normal_brand, roles.brand)
              .transform(clamp_to_null, rules.ranges)
              .transform(min_filled, roles.optional, rules.min_filled)
              .transform(keep_latest, roles.url, [roles.fetched_at, roles.id]))
    # The quartiles and the filter both read these rows: shuffle for the latest ones once.
    return (settle(latest)
            .transform(tukey_filter, roles.price, rules.min_price)
            .withColumn(roles.grade_code, ordinal_code(F.col(roles.grade), rules.grades)))


def clean_with_report(df: DataFrame, path: str, roles: Roles = Roles(), rules: CleanRules = CleanRules()) -> DataFrame:
    """Write the clean table to ``path`` and tell in one row how many rows each rule dropped.

    A row is counted for the first rule that it breaks: ``bez_obaveznih`` (a required field is missing), ``bez_cene`` (no
    positive price), ``bez_podataka`` (too few technical values), ``ponovljeni`` (a later offer of the same address),
    ``van_granica`` (outliers); ``before``, ``after``, ``dropped``, ``dropped_pct`` and ``too_few`` are those of
    ``cleaning_report``.  The counts are observed while the rows pass, so the input is scanned once for the table and
    the report.  Spark counts the rows of a stage again that it repeats after a lost executor; the number of input rows,
    which the footers of a stored table tell, shows that, and the flags are then counted by a scan of their own.
    """
    flagged = (nan_to_null(df).withColumn("_named", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in roles.required]))
               .withColumn("_priced", F.coalesce((F.col(roles.price) > 0) & ~F.isnan(F.col(roles.price).cast("double")), F.lit(False)))
               .transform(with_normal_brand, roles.brand)
               .transform(clamp_to_null, rules.ranges))
    named, priced, filled = F.col("_named"), F.col("_priced"), filled_count(roles.optional) >= rules.min_filled
    counts = [F.count(F.lit(1)).alias("before"), F.count_if(~named).alias("bez_obaveznih"), F.count_if(named & ~priced).alias("bez_cene"),
              F.count_if(named & priced & ~filled).alias("bez_podataka")]
    seen = Observation()
    passed = flagged.observe(seen, *counts).where(named & priced & filled).drop("_named", "_priced")
    latest = settle(keep_latest(passed, roles.url, [roles.fetched_at, roles.id]), "latest")
    (latest.transform(tukey_filter, roles.price, rules.min_price)
     .withColumn(roles.grade_code, ordinal_code(F.col(roles.grade), rules.grades)).write.mode("overwrite").parquet(path))
    n = df.count()
    # Spark leaves out a plan without rows, and then observes nothing.
    told = seen.get if n else dict.fromkeys(("before", "bez_obaveznih", "bez_cene", "bez_podataka"), 0)
    if told["before"] != n:
        told = flagged.agg(*counts).first().asDict()
    after, once = df.sparkSession.read.parquet(path).count(), latest.count()
    row = (told["before"], after, told["before"] - after, 100.0 * (told["before"] - after) / max(told["before"], 1), after < rules.min_rows,
           told["bez_obaveznih"], told["bez_cene"], told["bez_podataka"],
           told["before"] - told["bez_obaveznih"] - told["bez_cene"] - told["bez_podataka"] - once, once - after)
    return small_table(df.sparkSession, [row], "before bigint, after bigint, dropped bigint, dropped_pct double, too_few boolean, "
                       "bez_obaveznih bigint, bez_cene bigint, bez_podataka bigint, ponovljeni bigint, van_granica bigint")


def cleaning_report(before: DataFrame, after: DataFrame, min_rows: int = fixed.MIN_CLEAN_ROWS) -> DataFrame:
    """Row counts before and after, what was dropped, and whether too few rows are left."""
    n_before = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = after.agg(F.count(F.lit(1)).alias("after")).withColumn("before", n_before)
    dropped = F.col("before") - F.col("after")
    return counted.select(
        "before", "after", dropped.alias("dropped"),
        (F.lit(100.0) * dropped / F.greatest(F.col("before"), F.lit(1))).alias("dropped_pct"),
        (F.col("after") < min_rows).alias("too_few"))
