"""Ordinal codes, bands and verdicts as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.text import strip


def ordinal_code(label: Column, order: Sequence[str] = fixed.ENERGY_CLASSES) -> Column:
    """Position of the trimmed, upper-cased label in ``order``, from 1; unknown is NULL."""
    lookup = F.create_map(*[F.lit(v) for pair in zip([o.upper() for o in order], range(1, len(order) + 1))
                            for v in pair])
    return F.element_at(lookup, F.upper(strip(label)))


def price_band(price: Column, bands=fixed.PRICE_BANDS) -> Column:
    """Label of the band holding ``price``; upper edges belong to their band.

    A missing price falls into the last band.
    """
    last = bands[-1][1]
    chain = None
    for edge, label in bands[:-1]:
        test = (price <= F.lit(float(edge))) & ~F.isnan(price.cast("double"))
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(F.lit(last))


def silhouette_verdict(score: Column) -> Column:
    return F.when(score > 0.5, "dobar").when(score > 0.25, "osrednji").otherwise("los")


def fit_verdict(r2: Column) -> Column:
    return F.when(r2 > 0.5, "good").otherwise("poor")
