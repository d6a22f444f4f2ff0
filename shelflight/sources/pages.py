"""Stored web pages into offer records: one pass over a page's elements, the rest in column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions import text as tx
from shelflight.roles import OFFER_SCHEMA
from shelflight.session import ship_package
from shelflight.sources.elements import Element, Page, Tag


@dataclass(frozen=True)
class PageRules:
    """Where a shop puts things on its pages.  The defaults are fixed values of the first shop."""

    product_link: Tag = Tag("a", ("product-item-link",))
    next_link: Tag = Tag("a", ("action", "next"))
    title: Tag = Tag("span", ("base",), (("data-ui-id", "is", "page-title-wrapper"),))
    price_attribute: str = "data-price-amount"
    price: Tag = Tag("span", (), (("data-price-amount", "has", ""),))
    stock: Tag = Tag("div", ("stock",))
    brand: Sequence[Tag] = (Tag("a", (), (("href", "contains", "/brend/"),)), Tag("div", ("product-brand",)), Tag("span", ("brand",)))
    spec_table: Sequence[Tag] = (Tag("table", ("additional-attributes-wrapper",)),
                                 Tag("table", ("data", "table", "additional-attributes")))
    spec_row: Tag = Tag("tr")
    spec_label: Tag = Tag("th", ("col", "label"))
    spec_value: Tag = Tag("td", ("col", "data"))
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(fixed.SPEC_SYNONYMS))
    ignored: Sequence[str] = tuple(fixed.IGNORED_SPEC_KEYS)


@dataclass(frozen=True)
class CardRules:
    """Listing cards of the third shop, fixed values too."""

    card: Tag = Tag("div", ("product",))
    heading: Tag | None = Tag("h3", ("product-name",))
    link: Tag = Tag("a")
    price: Tag = Tag("", ("product-price",))


def per_page(html: Column, read: Callable[[Page], object], kind: str) -> Column:
    """``read`` of every page, sent to Python in Arrow batches.

    Spark copies what it takes for a plain expression into filters and generators, and every copy would parse the
    pages again.  So the function is declared as one that must not be copied; it runs once per page.
    """
    ship_package(SparkSession.active())
    return F.udf(lambda source: read(Page(source)), kind, useArrow=True).asNondeterministic()(html)


def _attribute(element: Element | None, name: str) -> str | None:
    return None if element is None else element.attributes.get(name)


def _specs(page: Page, rules: PageRules) -> dict[str, str]:
    """Lower-case label to value of the first spec table; blanks and ignored rows left out, the last of a label wins."""
    table = page.first(*rules.spec_table)
    found = {}
    for row in table.select(rules.spec_row) if table else ():
        label, value = row.first(rules.spec_label), row.first(rules.spec_value)
        if label is not None and value is not None:
            key, text = label.text.lower(), value.text
            if key and text and key not in rules.ignored:
                found[key] = text
    return found


def links(html: Column, tag: Tag = PageRules().product_link) -> Column:
    """Addresses of the matching links, first occurrences in page order."""
    def read(page: Page) -> list[str]:
        return list(dict.fromkeys(h for e in page.select(tag) if (h := _attribute(e, "href"))))

    return per_page(html, read, "array<string>")


def next_page(html: Column, tag: Tag = PageRules().next_link) -> Column:
    """Address of the next-page link, NULL on the last page."""
    return per_page(html, lambda page: _attribute(page.first(tag), "href"), "string")


def title(html: Column, tag: Tag = PageRules().title) -> Column:
    """Title text; NULL only when the page has no title element."""
    return per_page(html, lambda page: None if (e := page.first(tag)) is None else e.text, "string")


def stock(html: Column, tag: Tag = PageRules().stock) -> Column:
    return tx.stock_flag(per_page(html, lambda page: _attribute(page.first(tag), "class"), "string"))


def spec_map(html: Column, rules: PageRules = PageRules()) -> Column:
    """The first spec table as a map."""
    return per_page(html, lambda page: _specs(page, rules), "map<string,string>")


#: What one pass over a product page finds.
PRODUCT = "struct<title:string,brand:string,price:string,stock:string,specs:map<string,string>>"


def product_fields(html: Column, rules: PageRules = PageRules()) -> Column:
    """All fields of a product page; NULL for a page without a title."""
    def read(page: Page) -> tuple | None:
        named = page.first(rules.title)
        if named is None:
            return None
        brand = page.first(*rules.brand)
        return (named.text, None if brand is None else brand.text, _attribute(page.first(rules.price), rules.price_attribute),
                _attribute(page.first(rules.stock), "class"), _specs(page, rules))

    return per_page(html, read, PRODUCT)


def last_wins(pairs: Column) -> Column:
    """Map of ``(key, value)`` structs in which a repeated key keeps its last value."""
    def folded(ps: Column) -> Column:
        keys = F.array_distinct(F.transform(ps, lambda p: p["key"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(
            F.filter(ps, lambda p: p["key"] == k), -1)["value"]))

    return tx.let(pairs, folded)


def product_pages(pages: DataFrame, source: str, html: str = "html", url: str = "url",
                  category: str = "kategorija", rules: PageRules = PageRules()) -> DataFrame:
    """One offer per product page; pages without a title are not products."""
    found = pages.withColumn("_page", product_fields(F.col(html), rules)).where("_page IS NOT NULL")
    specs = F.col("_page.specs")

    def spec(name: str) -> Column:
        return tx.first_present(specs, rules.synonyms[name])

    record = {
        "izvor": F.lit(source), "izvorni_id": tx.id_in_url(F.col(url)), "url": F.col(url),
        "naziv": F.col("_page.title"), "brend": tx.brand_or_first_word(F.col("_page.brand"), F.col("_page.title")),
        "kategorija": F.col(category), "cena": tx.to_number(F.col("_page.price")), "na_lageru": tx.stock_flag(F.col("_page.stock")),
        "energetska_klasa": spec("energetska_klasa"), "sve_karakteristike": specs,
        **{c: tx.number_in(spec(c)) for c in ("dijagonala_inch", "kapacitet_kg", "zapremina_l", "snaga_w")},
    }
    return found.select(*offer_columns(record))


def cards(html: Column, rules: CardRules = CardRules()) -> Column:
    """Listing cards as ``array<struct<url, naziv, cena>>``; cards without a link are left out."""
    def read(page: Page) -> list[tuple]:
        found = []
        for card in page.select(rules.card):
            heading = card.first(rules.heading) if rules.heading else card
            link = None if heading is None else heading.first(rules.link)
            href = _attribute(link, "href")
            if href:
                price = card.first(rules.price)
                found.append((href, link.text, None if price is None else price.text))
        return found

    found = per_page(html, read, "array<struct<url:string,naziv:string,cena:string>>")
    return F.transform(found, lambda c: F.struct(c["url"].alias("url"), c["naziv"].alias("naziv"), tx.number_in(c["cena"]).alias("cena")))


def card_offers(cards_: DataFrame, source: str, page_text: str, category: str = "kategorija") -> DataFrame:
    """Offers of a listing-card shop: card fields plus attributes found in the product page's text."""
    attrs = tx.text_attributes(F.col(page_text))
    texts = F.map_from_arrays(F.array(*[F.lit(k) for k in attrs]),
                              F.array(*[v.cast("string") for v in attrs.values()]))
    record = {
        "izvor": F.lit(source), "url": F.col("url"), "naziv": F.col("naziv"),
        "brend": tx.brand_or_first_word(F.lit(None).cast("string"), F.col("naziv")),
        "kategorija": F.col(category), "cena": F.col("cena"), "na_lageru": F.lit(True), **attrs,
        "sve_karakteristike": F.map_filter(texts, lambda _, v: v.isNotNull()),
    }
    return cards_.select(*offer_columns(record))


def offer_columns(record: Mapping[str, Column]) -> list[Column]:
    """The common offer layout; fields a source does not deliver are NULL."""
    return [record.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OFFER_SCHEMA]
