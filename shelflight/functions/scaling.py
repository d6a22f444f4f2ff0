"""Scaling of numeric columns by statistics of the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight.functions.vectors import ratio


def number(column: str) -> Column:
    """The column as a double, NaN as NULL."""
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def column_stats(df: DataFrame, columns: Sequence[str], *functions) -> dict[str, Column]:
    """``<function>_<column>`` of every column from one pass, as literals."""
    row = df.agg(*[f(number(c)).alias(f"{f.__name__}_{c}") for c in columns for f in functions]).first()
    return {name: F.lit(value).cast("double") for name, value in row.asDict().items()}


def min_max(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Values between 0 and 1; a constant column becomes 0, a missing value stays missing."""
    s = column_stats(df, columns, F.min, F.max)
    out = {}
    for c in columns:
        x, low, high = number(c), s[f"min_{c}"], s[f"max_{c}"]
        out[c + suffix] = F.when(x.isNotNull(), ratio(x - low, high - low))
    return df.withColumns(out)


def z_score(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Centred values over the sample deviation; no deviation gives 0."""
    s = column_stats(df, columns, F.avg, F.stddev_samp)
    out = {}
    for c in columns:
        x = number(c)
        out[c + suffix] = F.when(x.isNotNull(), ratio(x - s[f"avg_{c}"], s[f"stddev_samp_{c}"]))
    return df.withColumns(out)
