"""Seeded draws that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Draws are whole numbers below this.
LIMIT = 1 << 52


def draw(id: Column, *seeds: int) -> Column:
    """A number drawn for ``id``: the first 13 hex digits of the MD5 of id and seeds joined by colons."""
    digest = F.md5(F.concat_ws(":", id.cast("string"), *[F.lit(str(s)) for s in seeds]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
