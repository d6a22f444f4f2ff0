"""Queries over the parameterised views."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflight.operators import views
from shelflight.plans import bindings as b
from shelflight.session import settle
from shelflight.sources import tables

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

#: Prices as a screen shows them, some unreadable.
SHOWN = "CASE WHEN id % 10 = 0 THEN 'n/a' ELSE CAST(CAST(cena AS BIGINT) AS STRING) || ' RSD' END AS prikaz"


def _sorted(s, d, column, numeric, descending):
    shown = b.catalogue(s, d).selectExpr("id", "brend", SHOWN)
    keyed = views.sort_view(shown, column, numeric, descending)
    return keyed.select("id", column, views.sort_key(shown, column, numeric).alias("kljuc"))


def _overview_of_loads(s, d):
    """Every shop's items are a load; their parts are stored, and the overview reads the parts alone."""
    parts = settle(views.overview_parts(b.catalogue(s, d), "izvor"), "overview")
    return b.rounded(views.overview_of_parts(parts), 6, "procenat_sa_klasom")


QUERIES = {
    "f1_overview": lambda s, d: b.rounded(views.overview(b.catalogue(s, d)), 6, "procenat_sa_klasom"),
    "f1_overview_of_loads": _overview_of_loads,
    "f2_largest_categories": lambda s, d: views.largest_categories(b.catalogue(s, d)),
    "f3_browse": lambda s, d: views.browse(b.catalogue(s, d))[0],
    "f3_browse_category": lambda s, d: views.browse(b.catalogue(s, d), category="PROMO")[0],
    "f3_browse_count": lambda s, d: views.browse(b.catalogue(s, d), category="PROMO")[1],
    "f4_sort_by_number": lambda s, d: _sorted(s, d, "prikaz", True, True).withColumn(
        "kljuc", F.when(F.col("kljuc") > float("-inf"), F.col("kljuc"))),
    "f4_sort_by_text": lambda s, d: _sorted(s, d, "brend", False, False),
    "f5_category_list": lambda s, d: views.category_list(b.catalogue(s, d)),
    "f6_first_examples": lambda s, d: b.plain_nulls(views.first_examples(b.catalogue(s, d))),
    "f7_inventory": lambda s, d: tables.inventory({t: b.table(s, d, t) for t in TABLES}),
    "f8_by_id": lambda s, d: b.plain_nulls(views.by_id(b.catalogue(s, d), 7)),
}

_FIRST = ["url", "naziv", "brend", "cena", "na_lageru", "energetska_klasa", "dijagonala_inch", "kapacitet_kg",
          "zapremina_l", "snaga_w", "izvor", "energetska_klasa_num"]



def _shown(value: str, column: str) -> str:
    kind = {"na_lageru": "VARCHAR", "energetska_klasa_num": "DOUBLE"}.get(column)
    return f"CAST({value} AS {kind})" if kind else value


SQL = {name: f"WITH {b.CATALOGUE_SQL} {sql}" for name, sql in {
    "f1_overview": """SELECT count(*) AS ukupno, count(DISTINCT kategorija) AS kategorija,
count(DISTINCT brend) AS brendova, min(cena) AS min_cena, max(cena) AS max_cena,
round(100.0 * count(energetska_klasa_num) / count(*), 6) AS procenat_sa_klasom FROM catalogue""",
    "f2_largest_categories": """SELECT kategorija, count(*) AS broj FROM catalogue GROUP BY kategorija
ORDER BY broj DESC, kategorija LIMIT 15""",
    "f3_browse": "SELECT id, naziv, brend, kategorija, cena FROM catalogue ORDER BY cena DESC, id LIMIT 500",
    "f3_browse_category": """SELECT id, naziv, brend, kategorija, cena FROM catalogue WHERE kategorija = 'PROMO'
ORDER BY cena DESC, id LIMIT 500""",
    "f3_browse_count": "SELECT count(*) AS zapisa FROM catalogue WHERE kategorija = 'PROMO'",
    "f4_sort_by_number": """SELECT id, CASE WHEN id % 10 = 0 THEN 'n/a' ELSE CAST(trunc(cena) AS BIGINT) || ' RSD' END
AS prikaz, CASE WHEN id % 10 = 0 THEN NULL ELSE trunc(cena) END AS kljuc FROM catalogue""",
    "f4_sort_by_text": "SELECT id, brend, lower(brend) AS kljuc FROM catalogue",
    "f5_category_list": "SELECT DISTINCT kategorija FROM catalogue",
    "f6_first_examples": "SELECT kategorija, min(id) AS id, " + ", ".join(
        f"{_shown(f'first({c} ORDER BY id) FILTER (WHERE {c} IS NOT NULL)', c)} AS {c}" for c in _FIRST)
        + " FROM catalogue WHERE cena IS NOT NULL GROUP BY kategorija",
    "f7_inventory": " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS n FROM {t}" for t in TABLES),
    "f8_by_id": f"SELECT * REPLACE ({b.FLAG_SQL}, {b.CODE_SQL}) FROM catalogue WHERE id = 7",
}.items()}
SQL["f1_overview_of_loads"] = SQL["f1_overview"]
