"""Queries over pages and offer documents.

The given pages have titles, links and lists but no prices or spec tables, so
shop pages are also written from the ``part`` table, one per part, and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions import text as tx
from shelflight.plans import bindings as b
from shelflight.session import settle
from shelflight.sources import offers, pages

#: What the shop pages and documents are written from.
SHOP_ITEMS = {
    "id": "p_partkey",
    "naziv": "p_name || ' <' || p_size || '>'",
    "brend": "CASE WHEN p_partkey % 6 <> 0 THEN p_brand END",
    "cena": b.CATALOGUE["cena"],
    "lista": "CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 100.0 ELSE 90000.0 END",
    "na_lageru": b.CATALOGUE["na_lageru"],
    "klasa": b.GRADE,
    "litara": "CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN p_size * 12 END",
    "kg": "CASE WHEN p_type = 'STANDARD' THEN p_size END",
    "vati": "CASE WHEN p_partkey % 5 <> 0 THEN 1000 + p_size END",
    "kategorija": "p_type",
}


#: Bytes of a page that is made of a part, about, and of the pages that one task reads.
PAGE_BYTES, TASK_BYTES = 2048, 4 << 20


def shop_items(spark: SparkSession, d: str) -> DataFrame:
    """A part is much shorter than its page, so parts are dealt out by the size of what is made of them."""
    parts = b.table(spark, d, "part")
    tasks = -(-parts.count() * PAGE_BYTES // TASK_BYTES)  # the count comes from the files' footers
    return (parts.repartition(tasks) if tasks > 1 else parts).selectExpr(*b.select(SHOP_ITEMS))


def _opt(value: Column, *parts) -> Column:
    """Concatenation, or nothing where ``value`` is missing."""
    return F.when(value.isNotNull(), F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise("")


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def shop_pages(spark: SparkSession, d: str) -> DataFrame:
    def row(label: str, value: Column) -> Column:
        return _opt(value, f'<tr>\n<th class="col label">{label}</th>\n<td class="col data"> ', value.cast("string"),
                    " </td></tr>")

    thousands = F.concat(F.lit("1."), F.substring(F.col("vati").cast("string"), 2, 3), F.lit(" W"))
    table = F.when(F.col("id") % 2 == 0, "additional-attributes-wrapper").otherwise("data table additional-attributes")
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body>"),
        F.when(F.col("id") % 31 != 0, F.concat(
            F.lit('<!-- <span class="base" data-ui-id="page-title-wrapper">stari naziv</span> -->'
                  '<span title="a > b" class="base" data-ui-id=page-title-wrapper><span> </span>\n '), _escaped(F.col("naziv")),
            F.lit("<span></span> </span>"))).otherwise(""),
        F.lit('<span data-price-amount="'), F.col("cena").cast("decimal(12,2)").cast("string"),
        F.lit('" class="price-wrapper"><span class="price">x</span></span>'),
        _opt(F.col("na_lageru"), '<div class="stock ', F.when(F.col("na_lageru"), "available").otherwise("unavailable"),
             '"><span>stanje</span></div>'),
        _opt(F.col("brend"), "<div class='product-brand'><div><i></i></div><p>", F.col("brend"), "</p></div>"),
        F.lit('<table class="'), table, F.lit('"><tbody>'),
        row("Energetska klasa", F.col("klasa")),
        row("Zapremina", _opt(F.col("litara"), F.col("litara").cast("string"), " l")),
        row("Kapacitet", F.concat(F.col("kg").cast("string"), F.lit(",5 kg"))),
        row("Import specifikacija", F.lit("<table><tr><td>Duboko</td><td>48 mm</td></tr><tr><td>Te&scaron;ko</td></tr></table>")),
        row("Snaga", F.when(F.col("vati").isNotNull(), thousands)),
        row("Boja", F.lit("zelena")), row("BOJA", F.lit("tamno plavi&scaron;&#0000038;")),
        F.lit("</tbody></table></body></html>"))
    return shop_items(spark, d).select(
        "id", F.concat(F.lit("https://shop.example/x-"), F.col("id").cast("string"),
                       F.when(F.col("id") % 3 == 0, "/").otherwise("")).alias("url"),
        "kategorija", html.alias("html"))


def offer_documents(spark: SparkSession, d: str) -> DataFrame:
    """One nested document per part, as JSON text."""
    def spec(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.array(value, F.lit("drugo")).alias("values"))

    def text(value: Column, unit: str) -> Column:
        return F.concat(value.cast("string"), F.lit(unit))

    specs = F.filter(F.array(
        spec("Energetska klasa", F.concat("klasa", F.lit(" - Novo"))),
        spec("Zapremina frižidera", text(F.col("litara"), " l")),
        spec("Kapacitet", text(F.col("kg"), ",5 kg")),
        spec("Kapacitet u kompletima", text(F.col("id"), " kom")),
        spec("Priključna snaga", text(F.col("vati"), " W")),
        spec("Online kupovina", F.when(F.col("na_lageru"), "Da").when(~F.col("na_lageru"), "Ne")),
    ), lambda s: F.get(s["values"], F.lit(0)).isNotNull())

    def prices(amount: Column) -> Column:
        return F.struct(amount.alias("highPrice"), amount.alias("lowPrice"))

    document = F.struct(
        F.col("naziv").alias("productName"), F.concat(F.lit("ref-"), F.col("id").cast("string")).alias("productReference"),
        F.col("brend").alias("brand"), F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("link"),
        F.array(F.concat(F.lit("/"), F.col("kategorija"), F.lit("/"))).alias("categories"),
        F.struct(prices(F.col("cena")).alias("sellingPrice"), prices(F.col("lista")).alias("listPrice")).alias("priceRange"),
        F.array(F.struct(specs.alias("specifications"))).alias("specificationGroups"))
    # Stored as a shop's answers are: a filter on a field would otherwise be pushed below the dealing out of the parts, and
    # there write and read the documents anew, in the one task that reads the parts.
    return settle(shop_items(spark, d).select("id", "kategorija", F.to_json(document).alias("dokument")), "documents")


def payload_pages(spark: SparkSession, d: str) -> DataFrame:
    """Listing pages of eight documents whose script carries them in two chunks, the first one twice."""
    docs = offer_documents(spark, d).withColumn("page_id", F.floor(F.col("id") / 8))
    listing = docs.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("id", "dokument"))).alias("d"))
    each = F.transform("d", lambda x: x["dokument"])
    payload = F.concat(F.lit('0:["$",{"items":['), F.array_join(each, ","), F.lit("]}]"), F.get(each, F.lit(0)))
    half = F.floor(F.length(payload) / 2).cast("int")

    def chunk(part: Column) -> Column:
        quoted = F.to_json(F.array(part))
        return F.concat(F.lit("<script>self.__next_f.push([1,"),
                        F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit("])</script>"))

    html = F.concat(F.lit("<html>"), chunk(F.substring(payload, F.lit(1), half)),
                    chunk(F.substring(payload, half + 1, F.length(payload))), F.lit("</html>"))
    return listing.select("page_id", html.alias("html"))


# -- queries ------------------------------------------------------------------

PAGE_LINK = pages.Tag("a")
NEXT = pages.Tag("a", (), (("href", "starts", "/th"),))


def links(spark: SparkSession, d: str) -> DataFrame:
    found = b.table(spark, d, "pages").select("page_id", pages.links(F.col("html"), PAGE_LINK).alias("l"))
    return found.select("page_id", F.posexplode("l").alias("pozicija", "href"))


def absolute(spark: SparkSession, d: str) -> DataFrame:
    base = F.regexp_extract("url", r"^([a-z]+://[^/]+/?)", 1)
    found = b.table(spark, d, "pages").select(
        "page_id", base.alias("base"), "url", pages.links(F.col("html"), PAGE_LINK).alias("l"))
    hrefs = F.concat("l", F.array("url"))
    return found.select("page_id", "base", F.explode(hrefs).alias("href")).select(
        "page_id", "href", tx.absolute_url(F.col("href"), F.col("base")).alias("adresa"))


def product_pages(spark: SparkSession, d: str) -> DataFrame:
    found = pages.product_pages(shop_pages(spark, d), "tehnomanija.rs")
    colour = F.element_at("sve_karakteristike", F.lit("boja"))
    return b.plain_nulls(found.withColumn("boja", colour).drop("sve_karakteristike"))


def page_titles(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "pages").select("page_id", pages.title(F.col("html"), pages.Tag("h1")).alias("naslov"))


def id_in_url(spark: SparkSession, d: str) -> DataFrame:
    return shop_pages(spark, d).select("id", "url", tx.id_in_url(F.col("url")).alias("izvorni_id"))


def brand(spark: SparkSession, d: str) -> DataFrame:
    return shop_items(spark, d).select("id", tx.brand_or_first_word(F.col("brend"), F.col("naziv")).alias("brend"))


def spec_map(spark: SparkSession, d: str) -> DataFrame:
    return shop_pages(spark, d).select("id", F.explode(pages.spec_map(F.col("html"))).alias("kljuc", "vrednost"))


def first_present(spark: SparkSession, d: str) -> DataFrame:
    specs = F.from_json("props", "map<string,string>")
    renamed = F.when(F.col("event_id") % 3 == 0, F.transform_keys(specs, lambda k, _: F.concat(k, F.lit("2"))))
    return b.table(spark, d, "events").select("event_id", F.coalesce(renamed, specs).alias("m")).select(
        "event_id", tx.first_present(F.col("m"), ["none", "k2", "k"]).alias("vrednost"))


def number_in_text(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "documents").select("doc_id", tx.number_in(F.col("text")).alias("broj"))


def stock(spark: SparkSession, d: str) -> DataFrame:
    return b.plain_nulls(shop_pages(spark, d).select("id", pages.stock(F.col("html")).alias("na_lageru")))


def embedded(spark: SparkSession, d: str) -> DataFrame:
    found = offers.parse_documents(offers.embedded_offers(payload_pages(spark, d)))
    return found.select("page_id", "pozicija", "referenca", F.col("productName").alias("naziv"))


def flat(spark: SparkSession, d: str) -> DataFrame:
    parsed = offers.parse_documents(offer_documents(spark, d))
    base = fixed.SHOP_BASES["gigatron.rs"]
    return offers.flatten_offers(parsed, "gigatron.rs", base).withColumn(
        "specifikacija", F.size("sve_karakteristike")).drop("sve_karakteristike")


def routed(spark: SparkSession, d: str) -> DataFrame:
    parsed = offers.parse_documents(offer_documents(spark, d))
    specs = pages.last_wins(offers.spec_pairs(F.col("specificationGroups")))
    return parsed.select("id", offers.routed_specs(specs).alias("r")).select("id", "r.*")


def class_token(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "part").select(
        "p_partkey", tx.class_token(F.concat(F.lit(" "), F.lower("p_type"), F.lit(" - x")), ["PROMO", "Small", "LARGE"])
        .alias("klasa"), tx.class_token(F.expr(b.GRADE)).alias("energetska_klasa"))


ATTRIBUTE_TEXT = """'Uređaj bele boje. Energetska klasa: ' || coalesce(klasa, 'nema') || '. Kapacitet punjenja: '
|| coalesce(kg, 0) || ',5 kg, bruto zapremina ' || coalesce(litara || ' l', 'nepoznata') || '; PRIKLJUČNA SNAGA '
|| coalesce(vati, 7) || ' W. Dijagonala ekrana: ' || id || '.'"""


def text_attributes(spark: SparkSession, d: str) -> DataFrame:
    pages_ = shop_items(spark, d).selectExpr("id", f"{ATTRIBUTE_TEXT} AS tekst")
    found = tx.text_attributes(F.col("tekst"))
    return pages_.select("id", *[c.alias(k) for k, c in found.items()])


#: Patterns that occur in the given documents.
DOCUMENT_PATTERNS = {
    "energetska_klasa": r"\b(?:the|of|and)\s+([a-g])\s",
    "kapacitet_kg": r"[:\s](\d[\d.,]*)\s*[\p{L}]",
    "zapremina_l": r"(?:th|en)[\p{L}\d_]*[^:]{0,25}[:\s]+([\d.,]*\d)",
}


def document_attributes(spark: SparkSession, d: str) -> DataFrame:
    found = tx.text_attributes(F.col("text"), DOCUMENT_PATTERNS)
    return b.table(spark, d, "documents").select("doc_id", *[c.alias(k) for k, c in found.items()])


def card_pages(spark: SparkSession, d: str) -> DataFrame:
    """One listing per part with the text of its product page."""
    price = F.when(F.col("vati").isNotNull(), F.concat(
        F.lit('<div><span class="product-price">'), F.replace(F.format_number("vati", 0), F.lit(","), F.lit(".")), F.lit("RSD</span></div>")))
    html = F.concat(F.lit("<ul>"), F.lit('<div class="product"><h3 class="product-name"><b>bez veze</b></h3></div>'),
                    F.lit('<div class="card product">\n <h3 class="product-name"><a class="x" href="https://x.example/'),
                    F.col("id").cast("string"), F.lit('.html"> '), _escaped(F.col("naziv")),
                    F.lit(" </a></h3>"), F.coalesce(price, F.lit("")),
                    F.lit('</div><aside><span class="product-price">777RSD</span></aside>'))
    return shop_items(spark, d).select("id", "kategorija", html.alias("html"), F.expr(ATTRIBUTE_TEXT).alias("tekst"))


def cards(spark: SparkSession, d: str) -> DataFrame:
    return card_pages(spark, d).select("id", F.explode(pages.cards(F.col("html"))).alias("c")).select("id", "c.*")


def shop_links(spark: SparkSession, d: str) -> DataFrame:
    """Listings with addresses that are quoted in all ways, commented out, repeated and written with references."""
    def link(start: str, end: str) -> Column:
        return F.concat(F.lit(start), F.col("id").cast("string"), F.lit(end))

    html = F.concat(link('<!-- <a class="product-item-link" href="/staro-', '">x</a> -->'),
                    link('<a title="1 > 0" class="product-item-link" href="/o\'reilly-', '">a</a>'),
                    link("<a class='big product-item-link' href='/b-", "?a=1&amp;b=&quot;2&quot;'>b</a>"),
                    link("<a href=/c-", " class=product-item-link>c</a>"), link("<script>'<a class=product-item-link href=/s-", ">'</script>"),
                    link('<a class="product-item-links" href="/ne-', '">x</a>'), link("<a href=/c-", " class=product-item-link>again</a>"),
                    link('<A CLASS="action next" HREF="/strana-', '">dalje</A>'))
    found = shop_items(spark, d).select("id", pages.links(html).alias("l"), pages.next_page(html).alias("sledeca"))
    return found.select("id", "sledeca", F.posexplode("l").alias("pozicija", "href"))


def shop_text(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit("<style>p{}</style><p>&Scaron;ifra&nbsp;"), F.col("id").cast("string"), F.lit(" &mdash; "), _escaped(F.col("naziv")),
                    F.lit("</p>&#x17E;&#382; &amp;lt; &unknown; &#0;<!-- x -->"))
    return shop_items(spark, d).select("id", tx.visible_text(html).alias("tekst"))


def list_cards(spark: SparkSession, d: str) -> DataFrame:
    rules = pages.CardRules(card=pages.Tag("li"), heading=None, link=pages.Tag("a"))
    found = b.table(spark, d, "pages").select("page_id", F.posexplode(pages.cards(F.col("html"), rules)).alias("pozicija", "c"))
    return found.select("page_id", "pozicija", "c.url", "c.naziv")


def card_offers(spark: SparkSession, d: str) -> DataFrame:
    cards_ = shop_items(spark, d).selectExpr(
        "'https://x.example/' || id AS url", "naziv", "cena", "kategorija", f"{ATTRIBUTE_TEXT} AS tekst")
    found = pages.card_offers(cards_, "metalac.rs", "tekst")
    return found.withColumn("specifikacija", F.size("sve_karakteristike")).drop("sve_karakteristike")


def visible_text(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "pages").select("page_id", tx.visible_text(F.col("html")).alias("tekst"))


def availability(spark: SparkSession, d: str) -> DataFrame:
    parsed = offers.parse_documents(offer_documents(spark, d))
    specs = pages.last_wins(offers.spec_pairs(F.col("specificationGroups")))
    return parsed.select("id", tx.availability(specs).alias("na_lageru"))


QUERIES = {
    "b1_links": links,
    "b2_next_page": lambda s, d: b.table(s, d, "pages").select(
        "page_id", pages.next_page(F.col("html"), NEXT).alias("sledeca")),
    "b1_b2_shop_links": shop_links,
    "b3_absolute_url": absolute,
    "b4_product_pages": product_pages,
    "b4_page_titles": page_titles,
    "b5_id_in_url": id_in_url,
    "b6_brand_or_first_word": brand,
    "b7_spec_map": spec_map,
    "b8_first_present_key": first_present,
    "b9_number_in_text": number_in_text,
    "b10_stock_flag": stock,
    "b11_embedded_offers": embedded,
    "b12_flatten_offers": flat,
    "b13_routed_specs": routed,
    "b14_class_token": class_token,
    "b15_text_attributes": text_attributes,
    "b15_document_attributes": document_attributes,
    "b16_cards": cards,
    "b16_list_cards": list_cards,
    "b16_card_offers": card_offers,
    "b17_visible_text": visible_text,
    "b17_shop_text": shop_text,
    "b18_availability": availability,
}

_ITEMS = f"items AS (SELECT {', '.join(b.select(SHOP_ITEMS))} FROM part)"
ITEMS_SQL = _ITEMS
_IN_LIST = "(" + ", ".join(f"'{g}'" for g in fixed.ENERGY_CLASSES) + ")"
_LINKS = """l AS (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1) AS l FROM pages),
e AS (SELECT page_id, url, unnest(l) AS href, generate_subscripts(l, 1) AS i FROM l),
u AS (SELECT page_id, url, replace(href, '&amp;', '&') AS href, min(i) AS i FROM e GROUP BY ALL)"""
_NUMBER = "TRY_CAST(nullif(regexp_extract(replace(replace({0}, '.', ''), ',', '.'), '([0-9]+(?:[.,][0-9]+)?)', 1), '') AS DOUBLE)"
_GRADE_OK = f"CASE WHEN upper(trim(klasa)) IN {_IN_LIST} THEN upper(trim(klasa)) END"


def _text_sql(patterns: dict[str, str], text: str) -> str:
    out = []
    for name, pattern in patterns.items():
        found = f"nullif(regexp_extract({text}, '(?i){pattern}', 1), '')"
        out.append((f"CASE WHEN upper({found}) IN {_IN_LIST} THEN upper({found}) END"
                    if name == "energetska_klasa" else _NUMBER.format(found)) + f" AS {name}")
    return ", ".join(out)


#: References that occur in the given pages.
REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "nbsp": " ", "copy": "©", "middot": "·", "eacute": "é", "amp": "&"}


def _entities(text: str) -> str:
    for name, char in REFERENCES.items():
        text = f"replace({text}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


_FLAT = f"""SELECT 'gigatron.rs' AS izvor, 'ref-' || id AS izvorni_id, 'https://gigatron.rs/p/' || id AS url,
naziv, brend, kategorija, '/' || kategorija || '/' AS podkategorija, nullif(cena, 0) AS cena,
CASE WHEN cena <> 0 AND lista > cena THEN lista END AS cena_pre_akcije, coalesce(na_lageru, true) AS na_lageru,
{_GRADE_OK} AS energetska_klasa, CAST(NULL AS DOUBLE) AS dijagonala_inch, kg + 0.5::DOUBLE AS kapacitet_kg,
litara::DOUBLE AS zapremina_l, vati::DOUBLE AS snaga_w,
1 + (klasa IS NOT NULL)::INT + (litara IS NOT NULL)::INT + (kg IS NOT NULL)::INT + (vati IS NOT NULL)::INT
+ (na_lageru IS NOT NULL)::INT AS specifikacija FROM items"""

#: White space of pages.
_WS_SQL = r"[\s\x{A0}]"
_STRIPPED = "(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<template\\b.*?</template\\s*>|<!doctype[^>]*>"

SQL = {
    "b1_links": f"""WITH {_LINKS}
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pozicija, href FROM u""",
    "b2_next_page": """SELECT page_id, nullif(replace(regexp_extract(html, '<a\\b[^>]*href="(/th[^"]*)"', 1),
'&amp;', '&'), '') AS sledeca FROM pages""",
    "b3_absolute_url": f"""WITH {_LINKS},
w AS (SELECT page_id, url, href FROM u UNION ALL SELECT page_id, url, url FROM pages)
SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href
ELSE rtrim(regexp_extract(url, '^([a-z]+://[^/]+/?)', 1), '/') || '/' || ltrim(href, '/') END AS adresa FROM w""",
    "b4_product_pages": f"""WITH {_ITEMS}
SELECT 'tehnomanija.rs' AS izvor, CAST(id AS VARCHAR) AS izvorni_id,
'https://shop.example/x-' || id || CASE WHEN id % 3 = 0 THEN '/' ELSE '' END AS url, naziv,
coalesce(brend, string_split(naziv, ' ')[1]) AS brend, kategorija, CAST(NULL AS VARCHAR) AS podkategorija, cena,
CAST(NULL AS DOUBLE) AS cena_pre_akcije, {b.FLAG_SQL}, trim(klasa) AS energetska_klasa,
CAST(NULL AS DOUBLE) AS dijagonala_inch, kg + 0.5::DOUBLE AS kapacitet_kg, litara::DOUBLE AS zapremina_l,
vati::DOUBLE AS snaga_w, 'tamno plaviš&' AS boja FROM items WHERE id % 31 <> 0""",
    "b4_page_titles": f"""SELECT page_id, CASE WHEN html LIKE '%<h1>%' THEN
trim({_entities("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) END AS naslov FROM pages""",
    "b5_id_in_url": """SELECT p_partkey AS id, 'https://shop.example/x-' || p_partkey ||
CASE WHEN p_partkey % 3 = 0 THEN '/' ELSE '' END AS url, CAST(p_partkey AS VARCHAR) AS izvorni_id FROM part""",
    "b6_brand_or_first_word": f"WITH {_ITEMS} SELECT id, coalesce(brend, string_split(naziv, ' ')[1]) AS brend FROM items",
    "b7_spec_map": f"""WITH {_ITEMS},
s AS (SELECT id, 'energetska klasa' AS kljuc, trim(klasa) AS vrednost FROM items
UNION ALL SELECT id, 'zapremina', litara || ' l' FROM items
UNION ALL SELECT id, 'kapacitet', kg || ',5 kg' FROM items
UNION ALL SELECT id, 'snaga', '1.' || lpad(CAST(vati - 1000 AS VARCHAR), 3, '0') || ' W' FROM items
UNION ALL SELECT id, 'boja', 'tamno plaviš&' FROM items)
SELECT * FROM s WHERE vrednost IS NOT NULL""",
    "b8_first_present_key": "SELECT event_id, json_extract_string(props, '$.k') AS vrednost FROM events",
    "b9_number_in_text": f"SELECT doc_id, {_NUMBER.format('text')} AS broj FROM documents",
    "b10_stock_flag": f"WITH {_ITEMS} SELECT id, {b.FLAG_SQL} FROM items",
    "b11_embedded_offers": f"""WITH {_ITEMS}
SELECT id // 8 AS page_id, id % 8 AS pozicija, 'ref-' || id AS referenca, naziv FROM items""",
    "b12_flatten_offers": f"WITH {_ITEMS} {_FLAT}",
    "b13_routed_specs": f"""WITH {_ITEMS}
SELECT id, {_GRADE_OK} AS energetska_klasa, printf('%.1f', vati::DOUBLE) AS snaga_w,
printf('%.1f', litara::DOUBLE) AS zapremina_l, printf('%.1f', kg + 0.5::DOUBLE) AS kapacitet_kg,
CAST(NULL AS VARCHAR) AS dijagonala_inch FROM items""",
    "b14_class_token": f"""SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN p_type END AS klasa,
CASE WHEN upper(trim({b.GRADE})) IN {_IN_LIST} THEN upper(trim({b.GRADE})) END AS energetska_klasa FROM part""",
    "b15_text_attributes": f"""WITH {_ITEMS}, t AS (SELECT id, {ATTRIBUTE_TEXT} AS tekst FROM items)
SELECT id, {_text_sql(fixed.TEXT_PATTERNS, 'tekst')} FROM t""",
    "b15_document_attributes": f"SELECT doc_id, {_text_sql(DOCUMENT_PATTERNS, 'text')} FROM documents",
    "b16_cards": f"""WITH {_ITEMS}
SELECT id, 'https://x.example/' || id || '.html' AS url, naziv, vati::DOUBLE AS cena FROM items""",
    "b1_b2_shop_links": f"""WITH {_ITEMS}, l AS (SELECT id, unnest([0, 1, 2]) AS pozicija FROM items)
SELECT id, '/strana-' || id AS sledeca, pozicija, CASE pozicija WHEN 0 THEN '/o''reilly-' || id
WHEN 1 THEN '/b-' || id || '?a=1&b="2"' ELSE '/c-' || id END AS href FROM l""",
    "b17_shop_text": f"""WITH {_ITEMS}
SELECT id, 'Šifra ' || id || ' — ' || trim(regexp_replace(naziv, ' +', ' ', 'g')) || ' žž &lt; &unknown; ' || chr(65533) AS tekst FROM items""",
    "b16_list_cards": f"""WITH l AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h,
regexp_extract_all(html, '<li><a href="[^"]*">(.*?)</a>', 1) AS t FROM pages),
e AS (SELECT page_id, generate_subscripts(h, 1) - 1 AS pozicija, unnest(h) AS url, unnest(t) AS naziv FROM l)
SELECT page_id, pozicija, {_entities('url')} AS url, trim({_entities('naziv')}) AS naziv FROM e""",
    "b16_card_offers": f"""WITH {_ITEMS}, t AS (SELECT *, {ATTRIBUTE_TEXT} AS tekst FROM items),
a AS (SELECT id, naziv, cena, kategorija, {_text_sql(fixed.TEXT_PATTERNS, 'tekst')} FROM t)
SELECT 'metalac.rs' AS izvor, CAST(NULL AS VARCHAR) AS izvorni_id, 'https://x.example/' || id AS url, naziv,
string_split(naziv, ' ')[1] AS brend, kategorija, CAST(NULL AS VARCHAR) AS podkategorija, cena,
CAST(NULL AS DOUBLE) AS cena_pre_akcije, true AS na_lageru, energetska_klasa, dijagonala_inch, kapacitet_kg,
zapremina_l, snaga_w, (energetska_klasa IS NOT NULL)::INT + (dijagonala_inch IS NOT NULL)::INT
+ (kapacitet_kg IS NOT NULL)::INT + (zapremina_l IS NOT NULL)::INT + (snaga_w IS NOT NULL)::INT AS specifikacija FROM a""",
    "b17_visible_text": f"""SELECT page_id, trim(regexp_replace({_entities(
        f"regexp_replace(regexp_replace(html, '{_STRIPPED}', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')")},
'{_WS_SQL}+', ' ', 'g')) AS tekst FROM pages""",
    "b18_availability": f"WITH {_ITEMS} SELECT id, coalesce(na_lageru, true) AS na_lageru FROM items",
}
