"""Queries over loading, storing, merging and collecting."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions import text as tx
from shelflight.operators import merge, reports
from shelflight.plans import bindings as b
from shelflight.session import settle, shared_folder, small_table
from shelflight.sources import collect, pages, tables
from shelflight.streaming.upsert import UpsertTable

#: Observations with some missing values, so that a missing latest value is seen to win.
OBSERVATIONS = ["event_id", "user_id", "event_type", "ts",
                "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value", "props"]
LATEST = ["value", "props", "ts"]


def observations(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "events").selectExpr(*OBSERVATIONS)


#: The given properties, beside nested ones, a list, a number written as text, and text that is no JSON.
NESTED = """CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '{"k": "' || user_id || '", "mera": {"v": ' || event_id % 50 || '.5, "t": "' || event_type || '"}}'
WHEN 2 THEN '{"mera": {"t": null, "v": true}, "niz": [' || user_id || ', "x"]}' WHEN 3 THEN '{"k": ' ELSE '{"prazno": {}}' END"""


def nested_props(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "events").selectExpr("event_id", f"{NESTED} AS specs")


def variant_specs(spark: SparkSession, d: str) -> DataFrame:
    return tables.variant_specs(nested_props(spark, d), "event_id", "specs")


def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    return merge.upsert(observations(spark, d), "user_id", ["ts", "event_id"], LATEST)


def upsert_offer_batch(spark: SparkSession, d: str) -> DataFrame:
    offers = b.raw_offers(spark, d)
    purchase = F.col("kategorija") == "purchase"
    by_user = offers.withColumn("url", F.substring_index("url", "/", 5))
    return b.plain_nulls(merge.upsert_offers(by_user.where(~purchase), by_user.where(purchase)))


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/shelflight/stream-{uuid4().hex}"
    target = UpsertTable(f"{folder}/table", "user_id", ["ts", "event_id"], LATEST)
    stream = spark.readStream.schema(b.table(spark, d, "events").schema).parquet(f"{d}/events*.parquet")
    target.start(stream.selectExpr(*OBSERVATIONS), f"{folder}/progress").awaitTermination()
    target.compact(spark)
    return target.read(spark)


def stream_repeated(spark: SparkSession, d: str) -> DataFrame:
    """The observations as a stream that delivers every record twice."""
    folder = f"{shared_folder(spark)}/shelflight/stream-{uuid4().hex}"
    target = UpsertTable(f"{folder}/table", "user_id", ["ts", "event_id"], LATEST)
    stream = spark.readStream.schema(b.table(spark, d, "events").schema).parquet(f"{d}/events*.parquet").selectExpr(*OBSERVATIONS)
    twice = stream.withColumn("_again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_again")
    target.start_once(twice.withColumn("ts", F.col("ts").cast("timestamp")), f"{folder}/progress", "ts", ["event_id"], "1 day").awaitTermination()
    return target.read(spark).withColumn("ts", F.col("ts").cast(b.table(spark, d, "events").schema["ts"].dataType))


def upsert_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Three batches, the later times not always in the later batch, into a table in buckets of the user."""
    rows = observations(spark, d)
    table = merge.BucketedTable(spark, f"kupci_{uuid4().hex}", "user_id", ["ts", "event_id"], [*LATEST, "event_id"], buckets=16)
    try:
        for part in range(3):
            table.upsert(rows.where(F.col("event_id") % 3 == part))
        return settle(table.read(), "bucketed")
    finally:
        table.drop()


def json_map(spark: SparkSession, d: str) -> DataFrame:
    events = b.table(spark, d, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 9 = 0 THEN NULL ELSE props END AS sve_karakteristike")
    parsed = tables.with_specs_map(events)
    return parsed.select("event_id", F.size("sve_karakteristike").alias("kljuceva"),
                         F.element_at("sve_karakteristike", F.lit("k")).alias("k"))


def reload_clean(spark: SparkSession, d: str) -> DataFrame:
    specs = F.create_map(F.lit("brend"), F.col("brend"))
    stored = tables.to_clean_schema(b.catalogue(spark, d).withColumn("sve_karakteristike", specs))
    path = f"{shared_folder(spark)}/shelflight/clean-{uuid4().hex}"
    back = tables.reload_table(stored, path, ["kategorija"])
    return b.plain_nulls(back).select("primarni_id", "izvor", "naziv", "brend", "kategorija", F.col("cena").cast("double").alias("cena"),
                       "na_lageru", "energetska_klasa", "energetska_klasa_num", "snaga_w", "sve_karakteristike")


BUNDLE_OPTIONS = {"top30_televizori_cena": {"category": "PROMO"}, "frizideri_po_velicini": {"category": "ECONOMY"}}


def report_bundle(spark: SparkSession, d: str) -> DataFrame:
    bundle = reports.report_bundle(b.catalogue(spark, d), **BUNDLE_OPTIONS)
    counts = reports.save_reports(bundle, f"{shared_folder(spark)}/shelflight/reports-{uuid4().hex}")
    return small_table(spark, list(counts.items()), "izvestaj string, redova long")


HOST = r"^[a-z]+://([^/]+)"


def union_sources(spark: SparkSession, d: str) -> DataFrame:
    all_pages = b.table(spark, d, "pages").withColumn("host", tx.first_match(F.col("url"), HOST))
    blog = all_pages.where(F.col("host").startswith("blog."))
    www = all_pages.where(F.col("host").startswith("www."))
    rest = all_pages.where(~F.col("host").startswith("blog.") & ~F.col("host").startswith("www."))
    h1 = pages.Tag("h1")
    return collect.union_sources({
        "blog": blog.select("page_id", "url", pages.title(F.col("html"), h1).alias("naziv")),
        "www": www.select("page_id", "url"),
        "ostalo": rest.select("page_id", "url", F.length("html").cast("double").alias("duzina"))})


def _slug_case() -> str:
    """A listing of the row's shop; the last choice is no known listing."""
    return "CASE p_partkey % 3 " + " ".join(
        f"WHEN {i} THEN {b.case(f'p_size % {len(slugs) + 1}', [*slugs, 'nepoznato'])}"
        for i, slugs in enumerate(fixed.CATEGORY_SLUGS.values())) + " END"


def slug_category(spark: SparkSession, d: str) -> DataFrame:
    listed = b.table(spark, d, "part").selectExpr("p_partkey", f"{b.SHOP} AS izvor", f"{_slug_case()} AS slug")
    mapping = collect.slug_table(spark).drop("redosled")
    return collect.with_category(listed, mapping, ["izvor", "slug"]).select("p_partkey", "izvor", "slug", "kategorija")


def price_only(spark: SparkSession, d: str) -> DataFrame:
    orders = b.table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 0.0 "
        "ELSE o_totalprice END AS cena")
    return collect.with_price_only(orders)


LANG = r'<html lang="([a-z]*)"'


def discovery(spark: SparkSession, d: str) -> DataFrame:
    listing = b.table(spark, d, "pages").select(
        tx.first_match(F.col("html"), LANG).alias("kategorija"), pages.links(F.col("html"), pages.Tag("a")).alias("l"))
    return collect.discovery(listing, "kategorija", F.size("l"))


#: Order of the categories.
LISTING = ["fr", "en", "de", "es"]
DOMAIN = r"^[a-z]+://[^/]*\.([a-z]+)(?:[/:?#]|$)"


def _visits(spark: SparkSession, d: str) -> DataFrame:
    """Source, page, category and its place in the listing; what a page does not state is empty, unlisted has no place."""
    place = F.array_position(F.array(*[F.lit(x) for x in LISTING]), F.col("kategorija"))
    return b.table(spark, d, "pages").select(
        F.regexp_extract("url", DOMAIN, 1).alias("izvor"), F.floor(F.col("page_id") / 5).alias("strana"),
        F.regexp_extract("html", LANG, 1).alias("kategorija"), F.length("html").alias("duzina")).withColumn(
        "redosled", F.nullif(place, F.lit(0)))


def collection_summary(spark: SparkSession, d: str) -> DataFrame:
    return collect.collection_summary(_visits(spark, d), "izvor", "strana", F.col("duzina") > 3000, "kategorija", "redosled")


def source_totals(spark: SparkSession, d: str) -> DataFrame:
    return collect.source_totals(_visits(spark, d), "izvor", F.col("duzina") > 3000)


def restore(spark: SparkSession, d: str) -> DataFrame:
    return tables.restore_when_empty(b.table(spark, d, "part").where("p_partkey < 0"), f"{d}/part.parquet")


def keep_full(spark: SparkSession, d: str) -> DataFrame:
    return tables.restore_when_empty(b.table(spark, d, "part"), f"{d}/nation.parquet")


QUERIES = {
    "a1_upsert_by_key": upsert_by_key,
    "a1_upsert_offer_batch": upsert_offer_batch,
    "a2_stream_upsert": stream_upsert,
    "a2_stream_repeated": stream_repeated,
    "a1_upsert_bucketed": upsert_bucketed,
    "a3_full_load": lambda s, d: tables.load(s, f"{d}/part.parquet", b.table(s, d, "part").schema),
    "a4_json_map": json_map,
    "a4_variant_specs": variant_specs,
    "a4_variant_schema": lambda s, d: tables.variant_schema(nested_props(s, d), "specs"),
    "a4_typed_specs": lambda s, d: tables.typed_specs(variant_specs(s, d), "event_id", {"k": "int", "mera.v": "double", "mera.t": "string"})
    .withColumnsRenamed({"mera.v": "v", "mera.t": "t"}),
    "a5_reload_clean": reload_clean,
    "a6_row_count": lambda s, d: tables.row_count(b.table(s, d, "lineitem")),
    "a7_report_bundle": report_bundle,
    "a8_union_sources": union_sources,
    "a9_slug_category": slug_category,
    "a10_price_only": price_only,
    "a11_discovery": discovery,
    "a12_collection_summary": collection_summary,
    "a12_source_totals": source_totals,
    "a13_restore_when_empty": restore,
    "a13_keep_full": keep_full,
}

_UPSERT = f"""
WITH o AS (SELECT {', '.join(OBSERVATIONS)} FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS up,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS down FROM o)
SELECT f.event_id, f.user_id, f.event_type, l.ts, l.value, l.props
FROM r f JOIN r l ON f.user_id = l.user_id WHERE f.up = 1 AND l.down = 1"""

_VISITS = f"""v AS (SELECT *, list_position({LISTING}, kategorija)::BIGINT AS redosled FROM (
SELECT regexp_extract(url, '{DOMAIN}', 1) AS izvor, page_id // 5 AS strana, regexp_extract(html, '{LANG}', 1) AS kategorija,
length(html) AS duzina FROM pages))"""

_VARIANT = """SELECT event_id, 'k' AS putanja, 'broj' AS tip, json_extract_string(props, '$.k') AS vrednost FROM events WHERE event_id % 5 = 0
UNION ALL SELECT event_id, 'k', 'tekst', user_id::VARCHAR FROM events WHERE event_id % 5 = 1
UNION ALL SELECT event_id, 'mera.v', 'broj', (event_id % 50)::VARCHAR || '.5' FROM events WHERE event_id % 5 = 1
UNION ALL SELECT event_id, 'mera.t', 'tekst', event_type FROM events WHERE event_id % 5 = 1
UNION ALL SELECT event_id, 'mera.t', 'prazno', NULL FROM events WHERE event_id % 5 = 2
UNION ALL SELECT event_id, 'mera.v', 'logicki', 'true' FROM events WHERE event_id % 5 = 2
UNION ALL SELECT event_id, 'niz[0]', 'broj', user_id::VARCHAR FROM events WHERE event_id % 5 = 2
UNION ALL SELECT event_id, 'niz[1]', 'tekst', 'x' FROM events WHERE event_id % 5 = 2"""

SQL = {
    "a1_upsert_by_key": _UPSERT,
    "a1_upsert_offer_batch": f"""
WITH {b.RAW_OFFERS_SQL},
o AS (SELECT * REPLACE (array_to_string(string_split(url, '/')[1:5], '/') AS url) FROM raw_offers),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY datum_preuzimanja, id) AS up,
             row_number() OVER (PARTITION BY url ORDER BY datum_preuzimanja DESC, id DESC) AS down FROM o)
SELECT f.id, f.url, f.naziv, f.brend, f.kategorija, l.cena, CAST(l.na_lageru AS VARCHAR) AS na_lageru, f.energetska_klasa, f.dijagonala_inch,
       f.kapacitet_kg, f.zapremina_l, f.snaga_w, f.izvor, l.datum_preuzimanja
FROM r f JOIN r l ON f.url = l.url WHERE f.up = 1 AND l.down = 1""",
    "a2_stream_upsert": _UPSERT,
    "a2_stream_repeated": _UPSERT,
    "a1_upsert_bucketed": _UPSERT.replace("SELECT f.event_id,", "SELECT l.event_id,"),
    "a3_full_load": "SELECT * FROM part",
    "a4_json_map": """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 0 ELSE len(json_keys(props)) END AS kljuceva,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events""",
    "a4_variant_specs": _VARIANT,
    "a4_typed_specs": f"""WITH s AS ({_VARIANT}) SELECT event_id, max(try_cast(vrednost AS INT)) FILTER (putanja = 'k') AS k,
max(try_cast(vrednost AS DOUBLE)) FILTER (putanja = 'mera.v') AS v, max(vrednost) FILTER (putanja = 'mera.t') AS t
FROM s WHERE putanja IN ('k', 'mera.v', 'mera.t') GROUP BY event_id""",
    "a5_reload_clean": f"""
WITH {b.CATALOGUE_SQL}
SELECT id AS primarni_id, izvor, naziv, brend, kategorija, cena, {b.FLAG_SQL}, energetska_klasa, {b.CODE_SQL},
       snaga_w, '{{"brend":"' || brend || '"}}' AS sve_karakteristike FROM catalogue""",
    "a6_row_count": "SELECT count(*) AS n FROM lineitem",
    "a7_report_bundle": f"""
WITH {b.CATALOGUE_SQL}
SELECT 'broj_po_kategoriji' AS izvestaj, count(DISTINCT kategorija) AS redova FROM catalogue
UNION ALL SELECT 'top10_brendovi', least(10, count(DISTINCT brend)) FROM catalogue
UNION ALL SELECT 'energ_klasa_C_ili_bolje', 1
UNION ALL SELECT 'cena_do_50000', 1
UNION ALL SELECT 'top30_televizori_cena', least(30, count(*)) FROM catalogue WHERE kategorija = 'PROMO'
UNION ALL SELECT 'statistike_cena_po_kategoriji', count(DISTINCT kategorija) FROM catalogue
UNION ALL SELECT 'procenat_klasa_A_po_kategoriji', count(DISTINCT kategorija) FROM catalogue
          WHERE energetska_klasa_num IS NOT NULL
UNION ALL SELECT 'top10_brendovi_po_ceni', least(10, count(*)) FROM
          (SELECT brend FROM catalogue GROUP BY brend HAVING count(*) >= 20)
UNION ALL SELECT 'dostupnost_po_kategoriji', count(DISTINCT kategorija) FROM catalogue WHERE na_lageru IS NOT NULL
UNION ALL SELECT 'frizideri_po_velicini', count(DISTINCT CASE WHEN zapremina_l < 200 THEN 1
          WHEN zapremina_l <= 400 THEN 2 ELSE 3 END) FROM catalogue
          WHERE kategorija = 'ECONOMY' AND zapremina_l IS NOT NULL""",
    "a8_union_sources": r"""
WITH h AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages),
k AS (SELECT *, CASE WHEN host LIKE 'blog.%' THEN 'blog' WHEN host LIKE 'www.%' THEN 'www' ELSE 'ostalo' END AS izvor
      FROM h)
SELECT page_id, url, CASE WHEN izvor = 'blog' THEN trim(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1),
       '&amp;', '&')) END AS naziv, CASE WHEN izvor = 'ostalo' THEN length(html)::DOUBLE END AS duzina, izvor FROM k""",
    "a9_slug_category": f"""
WITH m(izvor, slug, kategorija) AS (VALUES {', '.join(
        f"('{s}', '{slug}', '{c}')" for s, by in fixed.CATEGORY_SLUGS.items() for slug, c in by.items())}),
l AS (SELECT p_partkey, {b.SHOP} AS izvor, {_slug_case()} AS slug FROM part)
SELECT l.p_partkey, l.izvor, l.slug, m.kategorija FROM l LEFT JOIN m ON l.izvor = m.izvor AND l.slug = m.slug""",
    "a10_price_only": """
SELECT o_orderkey, o_totalprice AS cena FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0
AND o_totalprice <> 0""",
    "a11_discovery": f"""
SELECT regexp_extract(html, '{LANG}', 1) AS kategorija,
       CAST(sum(len(list_distinct(regexp_extract_all(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1)))) AS BIGINT) AS broj,
       CASE WHEN sum(len(regexp_extract_all(html, '(?i)<a\\b[^>]*href="([^"]*)"', 1))) > 0 THEN 'OK'
            ELSE 'PRAZNO' END AS status
FROM pages GROUP BY 1""",
    "a12_collection_summary": f"""
WITH {_VISITS},
p AS (SELECT izvor, kategorija, redosled, strana, count(*) FILTER (WHERE duzina > 3000) AS upisano, count(*) AS vidjeno
      FROM v GROUP BY ALL)
SELECT izvor, kategorija, redosled, strana, upisano, vidjeno,
       CAST(sum(upisano) OVER (PARTITION BY izvor ORDER BY redosled, strana) AS BIGINT) AS ukupno FROM p""",
    "a12_source_totals": f"""
WITH {_VISITS} SELECT izvor, count(*) FILTER (WHERE duzina > 3000) AS upisano FROM v GROUP BY izvor""",
    "a13_restore_when_empty": "SELECT * FROM part",
    "a13_keep_full": "SELECT * FROM part",
}
