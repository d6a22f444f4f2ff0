"""Collection from end to end: three shops, one table of offers, cleaning, a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.operators import clean, merge, reports
from shelflight.plans import bindings as b
from shelflight.plans import extract
from shelflight.plans.reports import price_stats_sql
from shelflight.session import settle
from shelflight.sources import collect, offers, pages


def collected(spark: SparkSession, d: str) -> DataFrame:
    """The offers of all shops as their pages and documents give them, numbered, with the time of the run."""
    listed = extract.card_pages(spark, d).select("kategorija", "tekst", F.explode(pages.cards(F.col("html"))).alias("c"))
    shops = {
        "tehnomanija.rs": pages.product_pages(extract.shop_pages(spark, d), "tehnomanija.rs"),
        "gigatron.rs": offers.flatten_offers(offers.parse_documents(extract.offer_documents(spark, d)), "gigatron.rs",
                                             fixed.SHOP_BASES["gigatron.rs"]),
        "metalac.rs": pages.card_offers(listed.select("kategorija", "tekst", "c.*"), "metalac.rs", "tekst"),
    }
    number = F.regexp_extract("url", r"([0-9]+)[^0-9]*$", 1).cast("long") * 3
    offset = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(shops) for x in (name, i)]), F.col("izvor"))
    return collect.union_sources(shops).withColumns({
        "id": number + offset, "datum_preuzimanja": F.lit("2024-05-02 06:00:00").cast("timestamp_ntz")})


def end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Prices per category after the offers of this run were merged into those of the last."""
    # Stored once: the last run's offers and this run's are both made of them, and cleaning filters by many of their columns.
    batch = settle(collect.with_price_only(collected(spark, d)), "batch")
    # The last run had half of the addresses, at twice the price.
    last = batch.where("id % 2 = 0").withColumns({
        "id": -F.col("id"), "cena": F.col("cena") * 2, "datum_preuzimanja": F.lit("2024-04-02 06:00:00").cast("timestamp_ntz")})
    return reports.price_stats(clean.clean(merge.upsert_offers(last, batch)))


QUERIES = {"a_collect_clean_report": end_to_end}

SQL = {"a_collect_clean_report": f"""WITH {extract.ITEMS_SQL},
batch AS (SELECT kategorija, cena FROM items WHERE id % 31 <> 0 UNION ALL SELECT kategorija, cena FROM items WHERE brend IS NOT NULL
UNION ALL SELECT kategorija, vati::DOUBLE FROM items),
priced AS (SELECT * FROM batch WHERE cena > 0),
q AS (SELECT quantile_cont(cena, 0.25) AS q1, quantile_cont(cena, 0.75) AS q3 FROM priced),
catalogue AS (SELECT p.* FROM priced p, q WHERE cena >= greatest(q1 - 1.5 * (q3 - q1), {fixed.MIN_PRICE}) AND cena <= q3 + 1.5 * (q3 - q1))
{price_stats_sql()}"""}
