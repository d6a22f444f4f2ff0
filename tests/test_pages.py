from __future__ import annotations

import json
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelflight.functions import text as tx
from shelflight.roles import OFFER_SCHEMA
from shelflight.plans import extract
from shelflight.sources import collect, offers, pages
from shelflight.sources.elements import Page, Tag, _remembered

LISTING = """<div><!-- <a class="product-item-link" href="https://radnja.example/obrisano">x</a> -->
<a class="product-item-link" href="https://radnja.example/o'neil-7">7</a>
<p><a href='https://radnja.example/rerna-8/?boja=1&amp;sirina=2' class='wide  product-item-link'>8</a></p>
<a title="a > b" class=product-item-link href=https://radnja.example/mikser-9>9</a>
<a class="product-item-link" href="https://radnja.example/o'neil-7">7 opet</a><a class="product-item-link">bez adrese</a>
<a class="product-item-links" href="https://radnja.example/ne">ne</a><script>"<a class='product-item-link' href='/ne'>"</script></div>
<A CLASS="next big action" HREF="https://radnja.example/spisak?strana=3">dalje</A>"""

PRODUCT = """<!DOCTYPE html><body><h1 class="base">nije naslov</h1>
<span data-ui-id=page-title-wrapper class='x base'> Oblak <b>rerna</b> R&amp;T <i>60</i> &scaron; </span>
<span data-price-amount="41250.50" class="price-wrapper"><span>41.250,50</span></span>
<div class="stock available low"><span>ima</span></div>
<div class="product-brand"><div></div>Ob<div>lak</div> <p>d.o.o.</p></div><a href="/brend/drugi">kasnije</a>
<table class="additional-attributes-wrapper">
<tr><th class="col label">Energetska klasa</th><td class="col data">B</td></tr>
<tr><th class="col label">Import specifikacija</th><td class="col data"><table><tr><td>Visina</td><td>59 cm</td></tr><tr><td>Masa</td></tr></table></td></tr>
<tr><th class="label col">Snaga</th><td class="data col">2.350 W</td></tr>
<tr><th class="col label">Prazno</th><td class="col data"> &nbsp; </td>
<tr><th class="col label">Nijansa</th><td class="col data">zelena</td></tr>
<tr><th class="col label">NIJANSA</th><td class="col data">sivi <!-- x --><em>&Zcaron;ad</em></td></tr>
</table><table class="additional-attributes-wrapper"><tr><th class="col label">Druga</th><td class="col data">1</td></tr></table>"""

UNAVAILABLE = """<span class="base" data-ui-id="page-title-wrapper">MERIDIAN sud</span>
<span data-price-amount="17d"></span><div class="stock unavailable"></div>
<table class="data table additional-attributes"><tr><th class="col label">Ukupna zapremina</th><td class="col data">54 l</td></tr>
<tr><th class="col label">Kapacitet</th><td class="col data">velik</td></tr></table>"""

EMPTY = "<html><body><p>Nema ni&#353;ta.</p></body></html>"


def value(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("v")).first()["v"]


def test_links_keep_order_and_drop_repeats(spark):
    assert value(spark, LISTING, pages.links(F.col("html"))) == [
        "https://radnja.example/o'neil-7", "https://radnja.example/rerna-8/?boja=1&sirina=2", "https://radnja.example/mikser-9"]
    assert value(spark, EMPTY, pages.links(F.col("html"))) == []
    assert value(spark, None, pages.links(F.col("html"))) == []


def test_next_page(spark):
    assert value(spark, LISTING, pages.next_page(F.col("html"))) == "https://radnja.example/spisak?strana=3"
    assert value(spark, EMPTY, pages.next_page(F.col("html"))) is None


def product(spark, html, url="https://radnja.example/x-90817/"):
    df = spark.createDataFrame([(html, url, "rerna")], "html string, url string, kategorija string")
    return pages.product_pages(df, "tehnomanija.rs").first()


def test_product_page(spark):
    p = product(spark, PRODUCT)
    assert (p.naziv, p.brend, p.cena, p.na_lageru) == ("OblakrernaR&T60š", "Oblakd.o.o.", 41250.5, True)
    assert (p.energetska_klasa, p.snaga_w, p.izvorni_id, p.kategorija) == ("B", 2350.0, "90817", "rerna")
    assert p.sve_karakteristike == {"energetska klasa": "B", "snaga": "2.350 W", "nijansa": "siviŽad"}


def test_unavailable_product_in_the_other_table(spark):
    p = product(spark, UNAVAILABLE)
    assert (p.na_lageru, p.cena, p.brend) == (False, None, "MERIDIAN")
    assert (p.zapremina_l, p.kapacitet_kg, p.energetska_klasa) == (54.0, None, None)


def test_page_without_product(spark):
    assert product(spark, EMPTY) is None and product(spark, None) is None


def test_cards(spark):
    html = """<ul><li><div class="big product"><div><h3 class="product-name"><span></span><a title='>' href="https://y.example/p?a=1&amp;b=2">Oblak <b>sud</b></a></h3></div>
    <p class="old product-price"> 8.450<small>RSD</small></p></div></li>
    <li><div class="product"><h3 class="product-name">bez adrese</h3><b class="product-price">1RSD</b></div></li>
    <li><div class="product"><h3 class="product-name"><a href=https://y.example/2>Vetar</a></h3></div></li></ul>
    <aside><i class="product-price">555RSD</i></aside>"""
    got = [(c.url, c.naziv, c.cena) for c in value(spark, html, pages.cards(F.col("html")))]
    assert got == [("https://y.example/p?a=1&b=2", "Oblaksud", 8450.0), ("https://y.example/2", "Vetar", None)]
    assert value(spark, "<div>nema</div>", pages.cards(F.col("html"))) == []


def test_elements_with_broken_markup():
    page = Page("<ul><li>1<li>2 <a>x</li></ul><div>a<div>b</div>c<p>d</div>e <x y='1\">z' Y=2>f</x> < g <br/>h</q><td>")
    texts = {(e.name, e.number): e.text for e in page.elements}
    assert [t for (n, _), t in texts.items() if n == "li"] == ["1", "2x"]
    assert [t for (n, _), t in texts.items() if n == "div"] == ["abcd", "b"]
    assert page.first(Tag("x")).attributes == {"y": "1\">z"} and page.first(Tag("x")).text == "f"
    assert page.first(Tag("br")).text == "" and page.first(Tag("td")).text == ""


@pytest.mark.parametrize("source, elements", [
    ("<a x='" * 170_000, 1), ("<select>" * 100_000, 100_000), ("<!" * 500_000, 0), ("<div>" * 60_000 + "</p>" * 60_000, 60_000),
    ("<li><ul>" + "<div>" * 40_000 + "<li></li>" * 40_000, 80_002), ("<a " + "= " * 400_000, 1), ("<" * 1_000_000, 0), ("<title>" * 100_000, 1),
])
def test_broken_pages_take_time_by_their_length(source, elements):
    start = time.perf_counter()
    assert len(Page(source).elements) == elements
    assert time.perf_counter() - start < 5


def test_long_tables_take_time_by_their_length():
    page = Page("<table>" + "".join(f"<tr><th>k{i}</th><td>v{i} <b>x</b></td></tr>" for i in range(20_000)) + "</table>")
    start = time.perf_counter()
    assert [row.first(Tag("td")).text for row in page.select(Tag("tr"))] == [f"v{i}x" for i in range(20_000)]
    assert time.perf_counter() - start < 5


def test_what_a_page_leaves_open_goes_to_its_end():
    assert [e.name for e in Page("<p>a<b x='1>c<i>d").elements] == ["p", "b"]
    assert Page("<p>a<b x='1>c<i>d").elements[0].text == "a"
    quotes = Page("<a title=it's class=x>b</a> <a it's href=/u>c</a>")
    assert [e.attributes.get("href") for e in quotes.elements] == [None, "/u"] and quotes.elements[0].classes == {"x"}


def test_pages_are_parsed_once(spark):
    df = spark.createDataFrame([(PRODUCT, "u-1", "frizider")], "html string, url string, kategorija string")
    for found in (pages.product_pages(df, "a"), df.select(F.posexplode(pages.links(F.col("html")))), df.select(F.explode(pages.spec_map(F.col("html"))))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


def test_character_references(spark):
    text = "&lt;b&gt; &scaron;&Zcaron;&eacute;&trade; &#0000038;&#x0000026;&#00000000000382; &amp;lt; &amp;amp; &nema; &#0;&#xD800;&#99999999999; & &x"
    want = "<b> šŽé™ &&ž &lt; &amp; &nema; \ufffd\ufffd\ufffd & &x"
    assert value(spark, text, tx.unescape(F.col("html"))) == want
    assert value(spark, None, tx.unescape(F.col("html"))) is None


def test_references_end_with_a_semicolon(spark):
    page = """<h1>so&ccedil;a&amp;&amp; n&amp</h1><a href="/?a=1&copy=2&amp;b=3">x &#x17E; &notit; &lt</a>"""
    assert value(spark, page, pages.title(F.col("html"), Tag("h1"))) == "soça&& n&amp"
    assert value(spark, page, pages.links(F.col("html"), Tag("a"))) == ["/?a=1&copy=2&b=3"]
    assert Page(page).first(Tag("a")).text == "x ž &notit; &lt"


def test_attributes_of_tags_written_alike_are_read_once():
    _remembered.cache_clear()
    page = Page("<i class='a  b' x=1>1</i>" * 50 + f"<i class=b title='{'x' * 300}'>2</i><i class='&#97;'>3</i>")
    assert [e.text for e in page.select(Tag("i", ("b",)))] == ["1"] * 50 + ["2"]
    assert [e.text for e in page.select(Tag("", ("a",)))] == ["1"] * 50 + ["3"]
    assert _remembered.cache_info().misses == 2


def test_filters_stay_behind_the_dealing_of_parts(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS p_partkey", "'x' AS p_name", "'y' AS p_brand", "'PROMO' AS p_type", "1 AS p_size",
                                   "2.0D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    parsed = offers.parse_documents(extract.offer_documents(spark, str(tmp_path))).where("productName <> ''")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "Repartition" not in plan and parsed.count() == 20_000


def test_offers_are_sent_on_by_few_pages(spark, monkeypatch):
    chunk = json.dumps(json.dumps({"productName": "a", "productReference": "r"}))
    html = f"<script>self.__next_f.push([1,{chunk}])</script>"
    df = spark.range(200).select(F.col("id").alias("page_id"), F.lit(html).alias("html")).repartition(1)
    sent = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, read, schema: sent.extend(
        read(iter(pa.Table.from_pylist([r.asDict() for r in self.collect()]).to_batches()))) or self)
    offers.embedded_offers(df)
    assert [b.num_rows for b in sent] == [64, 64, 64, 8] and sent[0].schema.names == ["page_id", "pozicija", "referenca", "dokument"]


def test_numbers_are_whole_texts(spark):
    rows = [" 12.5 ", "-3", "+.5", "4.", "1e3", "12d", "1.5f", "", " ", "1 2", "0x1A", "NaN", "1,5", "--1", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(tx.to_number(F.col("t"))).collect()] == [12.5, -3.0, 0.5, 4.0, 1000.0, *[None] * 10]
    assert [r[0] for r in spark.range(2).select(tx.to_number(F.col("id"))).collect()] == [0.0, 1.0]


RAW = {
    "productName": "VETAR sud 54 ", "productReference": "A-7", "brand": "Vetar", "link": "/vetar-54/p",
    "categories": ["/Kuhinja/"],
    "priceRange": {"sellingPrice": {"highPrice": 15750, "lowPrice": 15750},
                   "listPrice": {"highPrice": 18200, "lowPrice": 18200}},
    "specificationGroups": [{"specifications": [
        {"name": "Energetska klasa", "values": ["C (nova)"]}, {"name": "Zapremina posude", "values": ["54 l"]},
        {"name": "Snaga", "values": ["740 W"]}, {"name": "Bez vrednosti", "values": []}]}],
}


def flat(spark, *raws):
    df = spark.createDataFrame([(json.dumps(r), "frizider") for r in raws], "dokument string, kategorija string")
    return offers.flatten_offers(offers.parse_documents(df), "gigatron.rs", "https://gigatron.rs").collect()


def test_flatten_offer(spark):
    (p,) = flat(spark, RAW)
    assert (p.naziv, p.brend, p.url) == ("VETAR sud 54", "Vetar", "https://gigatron.rs/vetar-54/p")
    assert (p.cena, p.cena_pre_akcije, p.na_lageru) == (15750.0, 18200.0, True)
    assert (p.energetska_klasa, p.zapremina_l, p.snaga_w, p.kapacitet_kg) == ("C", 54.0, 740.0, None)


def test_flatten_edge_cases(spark):
    cheaper_list = {**RAW, "priceRange": {"sellingPrice": {"lowPrice": 5}, "listPrice": {"highPrice": 4}}}
    no_price = {"productName": "x", "priceRange": {"sellingPrice": {"lowPrice": 0}}}
    rows = flat(spark, cheaper_list, no_price, {"productName": ""})
    assert [(r.cena, r.cena_pre_akcije) for r in rows] == [(5.0, None), (None, None)]


def test_routing_lets_a_key_fall_through(spark):
    specs = [{"name": "Snaga i zapremina", "values": ["90 W"]}, {"name": "Snaga zapremina", "values": ["7 l"]},
             {"name": "Kapacitet", "values": ["5 kompleta"]}, {"name": "Kapacitet pranja", "values": ["8,5 KG"]},
             {"name": "Energetska klasa", "values": ["Z"]}, {"name": "Energetska klasa snaga", "values": ["A+ x"]}]
    (p,) = flat(spark, {**RAW, "specificationGroups": [{"specifications": specs}]})
    assert (p.snaga_w, p.zapremina_l, p.kapacitet_kg, p.energetska_klasa) == (90.0, 7.0, 8.5, "A+")


def chunk(text):
    return f"<script>self.__next_f.push([1,{json.dumps(text)}])</script>"


def harvest(spark, *htmls):
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")
    return offers.embedded_offers(df).orderBy("page_id", "pozicija").collect()


def test_embedded_offers(spark):
    text = json.dumps(RAW)
    nested = '1:["$",{"a":[' + text + ',{"productName":"Y"}]}]{broken {"productName":"Z"}' + text
    half = len(nested) // 2
    rows = harvest(spark, chunk(nested[:half]) + "<p>x</p>" + chunk(nested[half:]), EMPTY, None)
    # The second and third offers have no reference; both count as one.
    assert [(r.page_id, r.referenca, json.loads(r.dokument)["productName"]) for r in rows] == [
        (0, "A-7", RAW["productName"]), (0, None, "Y")]


def test_bad_chunk_is_skipped(spark):
    bad = 'self.__next_f.push([1,"\\x"])'
    assert len(harvest(spark, bad + chunk(json.dumps(RAW)))) == 1


def test_card_offers(spark):
    df = spark.createDataFrame([("u", "Munja M31", 7350.0, "frizider", "Zapremina: 118 l. Energetski razred: F")],
                               "url string, naziv string, cena double, kategorija string, tekst string")
    p = pages.card_offers(df, "metalac.rs", "tekst").first()
    assert (p.brend, p.zapremina_l, p.energetska_klasa, p.na_lageru) == ("Munja", 118.0, "F", True)
    assert p.sve_karakteristike == {"energetska_klasa": "F", "zapremina_l": "118.0"}


def test_sources_share_one_layout(spark):
    first = pages.product_pages(spark.createDataFrame([(PRODUCT, "u-1", "frizider")],
                                                      "html string, url string, kategorija string"), "a")
    both = collect.union_sources({"a": first.drop("izvor"), "b": first.select("url", "naziv")})
    assert {r.izvor: r.cena for r in both.collect()} == {"a": 41250.5, "b": None}
    assert first.schema.names == OFFER_SCHEMA.names


def test_slug_table(spark):
    table = collect.slug_table(spark)
    assert table.groupBy("izvor").count().orderBy("count").rdd.map(tuple).collect() == [
        ("gigatron.rs", 17), ("metalac.rs", 25), ("tehnomanija.rs", 27)]


def test_discovery_reports_empty_listings(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 0), ("c", None)], "kategorija string, n int")
    got = {r.kategorija: (r.broj, r.status) for r in collect.discovery(df, "kategorija", F.col("n")).collect()}
    assert got == {"a": (3, "OK"), "b": (0, "PRAZNO"), "c": (0, "PRAZNO")}
