"""Nested offer documents embedded in pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelflight import fixed_values as fixed
from shelflight.functions import text as tx
from shelflight.session import ship_package
from shelflight.sources.pages import last_wins, offer_columns

#: One offer document.
DOCUMENT = """productName string, productReference string, brand string, link string,
categories array<string>,
priceRange struct<sellingPrice: struct<highPrice: double, lowPrice: double>,
                  listPrice: struct<highPrice: double, lowPrice: double>>,
specificationGroups array<struct<specifications: array<struct<name: string, values: array<string>>>>>"""

CHUNK = re.compile(fixed.SCRIPT_CHUNK, re.S)

#: Pages whose offers a task holds at once.
PAGES_AT_ONCE = 64


def _offers_within(value) -> Iterator[dict]:
    """Objects with a product name, outermost first, in document order."""
    if isinstance(value, dict):
        if "productName" in value:
            yield value
            return
        value = list(value.values())
    for item in value if isinstance(value, list) else ():
        yield from _offers_within(item)


def _chunk_text(chunk: str) -> str:
    """Text of one chunk; a chunk that is no JSON string carries nothing."""
    try:
        return json.loads(chunk)
    except ValueError:
        return ""


def _offers_in_page(html: str) -> list[tuple[str | None, str]]:
    """Reference and JSON text of each offer of a page; a repeated reference counts once."""
    payload = "".join(map(_chunk_text, CHUNK.findall(html or "")))
    decoder, at, by_reference = json.JSONDecoder(), payload.find("{"), {}
    while at >= 0:
        try:
            value, end = decoder.raw_decode(payload, at)
        except ValueError:
            at = payload.find("{", at + 1)
            continue
        for offer in _offers_within(value):
            by_reference.setdefault(json.dumps(offer.get("productReference")), offer)
        at = payload.find("{", end)
    return [(offer.get("productReference"), json.dumps(offer, ensure_ascii=False)) for offer in by_reference.values()]


def embedded_offers(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(key, pozicija, referenca, dokument)`` for every offer document inside the pages' scripts."""
    key_type = pages.schema[key].dataType.simpleString()
    found = to_arrow_schema(StructType.fromDDL(f"{key} {key_type}, pozicija int, referenca string, dokument string"))

    def harvest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A page's offers are longer than the page is in Arrow, so a batch is taken apart and sent on by few pages.
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                rows = [(k, i, None if ref is None else str(ref), doc) for k, page in zip(part[key].to_pylist(), part[html].to_pylist())
                        for i, (ref, doc) in enumerate(_offers_in_page(page))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), found)], schema=found)

    ship_package(pages.sparkSession)
    return pages.select(key, html).mapInArrow(harvest, f"{key} {key_type}, pozicija int, referenca string, dokument string")


def parse_documents(df: DataFrame, column: str = "dokument") -> DataFrame:
    """Replace the JSON text by the fields of the offer document."""
    return df.withColumn("_doc", F.from_json(column, DOCUMENT)).select(
        *[c for c in df.columns if c != column], "_doc.*")


def spec_pairs(groups: Column) -> Column:
    """All specs of all groups as ``(key, value)``, with the first value of each; empty ones are left out."""
    no_specs = F.array().cast("array<struct<name:string,values:array<string>>>")
    flat = F.flatten(F.transform(F.coalesce(groups, F.array().cast(
        "array<struct<specifications:array<struct<name:string,values:array<string>>>>>")),
        lambda g: F.coalesce(g["specifications"], no_specs)))
    valued = F.filter(flat, lambda s: F.coalesce(F.size(s["values"]), F.lit(0)) > 0)
    return F.transform(valued, lambda s: F.struct(
        F.coalesce(s["name"], F.lit("")).alias("key"),
        F.coalesce(F.get(s["values"], F.lit(0)), F.lit("None")).alias("value")))


def routed_specs(specs: Column, routes: Sequence[tuple[str, str, str | None]] = fixed.SPEC_ROUTES,
                 grade: str = "energetska_klasa") -> Column:
    """Struct with one text per target, filled from the specs in order.

    A spec goes to the first target in ``routes`` that is still empty and whose
    texts it contains.  A grade text outside the allowed classes, or a number
    text without a number, leaves the target empty but uses up the spec.
    """
    empty = F.struct(*[F.lit(None).cast("string").alias(t) for t, _, _ in routes])

    def take(state: Column, entry: Column) -> Column:
        key, value = F.lower(entry["key"]), entry["value"]
        usable = {t: tx.class_token(value) if t == grade else tx.number_in(value).cast("string")
                  for t, _, _ in routes}
        open_ = F.lit(True)
        fields = []
        for target, in_key, in_value in routes:
            fits = state[target].isNull() & key.contains(in_key)
            if in_value:
                fits = fits & F.lower(value).contains(in_value)
            fields.append(F.when(open_ & fits, usable[target]).otherwise(state[target]).alias(target))
            open_ = open_ & ~fits
        return F.struct(*fields)

    return F.aggregate(F.map_entries(specs), empty, take)


def flatten_offers(df: DataFrame, source: str, base: str, category: str = "kategorija") -> DataFrame:
    """Nested offer documents as flat offers; documents without a name are left out."""
    selling = F.col("priceRange.sellingPrice.lowPrice")
    listed = F.col("priceRange.listPrice.highPrice")
    link = F.coalesce(F.col("link"), F.lit(""))
    staged = (df.where(F.coalesce(F.col("productName"), F.lit("")) != "")
              .withColumn("_specs", last_wins(spec_pairs(F.col("specificationGroups"))))
              .withColumn("_routed", routed_specs(F.col("_specs"))))
    record = {
        "izvor": F.lit(source), "izvorni_id": F.coalesce("productReference", F.lit("")),
        "url": F.when(link.startswith("/"), F.concat(F.lit(base), link)).otherwise(link),
        "naziv": tx.strip(F.col("productName")), "brend": F.col("brand"), "kategorija": F.col(category),
        "podkategorija": F.get("categories", F.lit(0)),
        "cena": F.nullif(selling, F.lit(0.0)),
        "cena_pre_akcije": F.when((selling != 0) & (listed > selling), listed),
        "na_lageru": tx.availability(F.col("_specs")),
        "energetska_klasa": F.col("_routed.energetska_klasa"), "sve_karakteristike": F.col("_specs"),
        **{c: F.col(f"_routed.{c}") for c in ("dijagonala_inch", "kapacitet_kg", "zapremina_l", "snaga_w")},
    }
    return staged.select(*offer_columns(record))
