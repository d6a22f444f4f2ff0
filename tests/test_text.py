from __future__ import annotations

import html as html_module

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions import codes
from shelflight.functions import text as tx


def one(spark, make, *values):
    row = spark.range(1).select(*[F.lit(v).alias(f"v{i}") for i, v in enumerate(values)])
    return row.select(make(*[F.col(f"v{i}").cast("string") if v is None else F.col(f"v{i}")
                             for i, v in enumerate(values)]).alias("r")).first()["r"]


def many(spark, make, values, type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type}")
    return [r["r"] for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_number_in(spark):
    texts = ["oko 47 kom", "3,25 m", "7.400", "bez broja", None, "", "6.1", "918 g", "5.310din"]
    assert many(spark, tx.number_in, texts) == [47.0, 3.25, 7400.0, None, None, None, 61.0, 918.0, 5310.0]


def test_ordinal_code(spark):
    texts = ["G", "A", "A+", "A++", "A+++", "a+++", "g", None, "", "Z", "A++++", "  A+  ", "nan"]
    assert many(spark, codes.ordinal_code, texts) == [1, 7, 8, 9, 10, 10, 1, None, None, None, None, 8, None]
    assert many(spark, codes.ordinal_code, fixed.ENERGY_CLASSES) == list(range(1, 11))


def test_price_band(spark):
    prices = [15000.0, 30000.0, 30001.0, 99999.0, 100001.0, 299999.0, 300000.0, 300001.0, 1e6, None, float("nan")]
    low, mid, high, top = (label for _, label in fixed.PRICE_BANDS)
    assert many(spark, codes.price_band, prices, "double") == [
        low, low, mid, mid, high, high, high, top, top, top, top]


def test_verdicts(spark):
    assert many(spark, codes.silhouette_verdict, [0.51, 0.5, 0.25, 0.1], "double") == [
        "dobar", "osrednji", "los", "los"]
    assert many(spark, codes.fit_verdict, [0.51, 0.5], "double") == ["good", "poor"]


def test_absolute_url(spark):
    base = "https://www.shop.example/"
    got = many(spark, lambda c: tx.absolute_url(c, base), ["https://x/1", "/a/b/", "a/b/", "//a"])
    assert got == ["https://x/1", "https://www.shop.example/a/b/", "https://www.shop.example/a/b/",
                   "https://www.shop.example/a"]


def test_id_in_url(spark):
    assert many(spark, tx.id_in_url, ["https://x/frizider-123456/", "https://x/a-7", "https://x/a-7/b", "x"]) == [
        "123456", "7", None, None]


def test_brand_falls_back_to_first_word(spark):
    assert one(spark, tx.brand_or_first_word, " Bosch ", "LG x") == "Bosch"
    assert one(spark, tx.brand_or_first_word, "", " LG  frižider") == "LG"
    assert one(spark, tx.brand_or_first_word, None, "") is None


def test_normal_brand_strips_every_blank(spark):
    assert many(spark, tx.normal_brand, [" Vox\t", " gorenje\n", "LG"]) == ["VOX", "GORENJE", "LG"]


def test_class_token(spark):
    assert many(spark, tx.class_token, ["E - Novo", " a++ ", "Z", "", None, "Eko"]) == ["E", "A++", None, None, None, None]


def test_stock_flag_needs_the_whole_word(spark):
    assert many(spark, tx.stock_flag, ["stock available", "stock unavailable", None]) == [True, False, None]


def attributes(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(*[c.alias(k) for k, c in tx.text_attributes(F.col("t")).items()]).first()
    return {k: v for k, v in row.asDict().items() if v is not None}


@pytest.mark.parametrize("text, want", [
    ("Energetski razred: E", {"energetska_klasa": "E"}),
    ("Energetska klasa A++", {"energetska_klasa": "A++"}),
    ("energetska klasa: b+", {}),
    ("Kapacitet punjenja: 8 kg", {"kapacitet_kg": 8.0}),
    ("Kapacitet punjenja: 8,5 kg", {"kapacitet_kg": 8.5}),
    ("Zapremina: 242 l", {"zapremina_l": 242.0}),
    ("Zapremina: 242 lm", {}),
    ("Neto zapremina: 1.242 litara", {"zapremina_l": 1242.0}),
    ("Snaga: 2000 W", {"snaga_w": 2000.0}),
    ("PRIKLJUČNA SNAGA: 90 W", {"snaga_w": 90.0}),
    ("Dijagonala ekrana: 55", {"dijagonala_inch": 55.0}),
    ("Boja: bela", {}),
])
def test_text_attributes(spark, text, want):
    assert attributes(spark, text) == want


def test_availability(spark):
    df = spark.createDataFrame([({"Online kupovina": "Da"},), ({"Online kupovina": "NE"},), ({"x": "y"},),
                                ({"Online kupovina": "TRUE"},)], "m map<string,string>")
    assert [r[0] for r in df.select(tx.availability(F.col("m"))).collect()] == [True, False, True, True]


def test_unescape(spark):
    texts = ["a &amp; b", "&lt;b&gt;", "&#353;&#x161;&#X161;", "&amp;lt;", "x &unknown; y", "&quot;&apos;", "5 < 6 & 7"]
    assert many(spark, tx.unescape, texts) == ["a & b", "<b>", "ššš", "&lt;", "x &unknown; y", "\"'", "5 < 6 & 7"]


def test_visible_text(spark):
    page = ("<!DOCTYPE html><html><head><title>T</title><script>var a = '</p>';</script><style>p{}</style></head>"
            "<body><!-- no --><p>Jedan&nbsp;<b>dva</b></p>\n tri &amp; &#269;</body></html>")
    assert many(spark, tx.visible_text, [page]) == ["T Jedan dva tri & č"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB1š-\t\n   +ßŽ", max_size=20), min_size=1, max_size=8))
def test_tokens_like_python(spark, texts):
    want = [[w.lower() for w in t.replace("-", " ").split() if len(w) > 1] for t in texts]
    assert many(spark, tx.tokens, texts) == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["&amp;", "&lt;", "&#353;", "&#x17E;", "&nbsp;", "&euro;", "a", " ", "5", "; "]),
                         max_size=8).map("".join), min_size=1, max_size=8))
def test_unescape_like_python(spark, texts):
    assert many(spark, tx.unescape, texts) == [html_module.unescape(t) for t in texts]
