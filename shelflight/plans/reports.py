"""Queries over the ten reports."""

from __future__ import annotations

from shelflight import fixed_values as fixed
from shelflight.operators import reports
from shelflight.plans import bindings as b


def _query(report, **options):
    return lambda s, d: report(b.catalogue(s, d), **options)


def _money_mean(digits: int) -> str:
    """Average of two-digit prices rounded half up in whole numbers, so exactly."""
    scale = 10 ** digits
    cents = "sum(CAST(round(cena * 100) AS HUGEINT))"
    return f"CAST((2 * {scale} * {cents} + 100 * count(*)) // (200 * count(*)) AS DOUBLE) / {scale}"


def _percent(part: str) -> str:
    return f"CAST((2000 * ({part}) + count(*)) // (2 * count(*)) AS DOUBLE) / 10"


QUERIES = {
    "d1_count_per_category": _query(reports.count_per_category),
    "d2_top_brands": _query(reports.top_brands),
    "d3_count_grade_c_or_better": _query(reports.count_grade_at_least),
    "d4_count_price_up_to": _query(reports.count_price_up_to, price=20_000),
    "d5_dearest_of_category": _query(reports.dearest_of_category, category="PROMO"),
    "d6_price_stats": _query(reports.price_stats),
    "d7_grade_share": _query(reports.grade_share),
    "d8_dearest_brands": _query(reports.dearest_brands),
    "d9_stock_share": _query(reports.stock_share),
    "d10_by_size": _query(reports.by_size, category="ECONOMY"),
}


def price_stats_sql() -> str:
    return _SQL["d6_price_stats"]


_SQL = {
    "d1_count_per_category": "SELECT kategorija, count(*) AS broj_proizvoda FROM catalogue GROUP BY kategorija",
    "d2_top_brands": """SELECT brend, count(*) AS broj_proizvoda FROM catalogue GROUP BY brend
ORDER BY broj_proizvoda DESC, brend LIMIT 10""",
    "d3_count_grade_c_or_better": "SELECT count(*) AS broj_proizvoda FROM catalogue WHERE energetska_klasa_num >= 5",
    "d4_count_price_up_to": "SELECT count(*) AS broj_proizvoda FROM catalogue WHERE cena <= 20000",
    "d5_dearest_of_category": """SELECT naziv, brend, cena, dijagonala_inch, energetska_klasa FROM catalogue
WHERE kategorija = 'PROMO' ORDER BY cena DESC, id LIMIT 30""",
    "d6_price_stats": f"""SELECT kategorija, count(*) AS broj_proizvoda, {_money_mean(2)} AS prosecna_cena,
min(cena) AS min_cena, max(cena) AS max_cena, round(stddev_samp(cena), 2) AS std_cena FROM catalogue GROUP BY kategorija""",
    "d7_grade_share": f"""SELECT kategorija, count(*) AS ukupno,
count(*) FILTER (WHERE energetska_klasa_num >= 7) AS klasa_a_ili_bolja,
{_percent("count(*) FILTER (WHERE energetska_klasa_num >= 7)")} AS procenat_klasa_a
FROM catalogue WHERE energetska_klasa_num IS NOT NULL GROUP BY kategorija""",
    "d8_dearest_brands": f"""SELECT brend, count(*) AS broj_proizvoda, {_money_mean(0)} AS prosecna_cena,
round(min(cena)) AS min_cena, round(max(cena)) AS max_cena FROM catalogue GROUP BY brend HAVING count(*) >= 20
ORDER BY prosecna_cena DESC, brend LIMIT 10""",
    "d9_stock_share": f"""SELECT kategorija, count(*) AS ukupno, count(*) FILTER (WHERE na_lageru) AS na_lageru,
count(*) FILTER (WHERE NOT na_lageru) AS nije_na_lageru,
{_percent("count(*) FILTER (WHERE na_lageru)")} AS procenat_na_lageru
FROM catalogue WHERE na_lageru IS NOT NULL GROUP BY kategorija""",
    "d10_by_size": f"""SELECT CASE WHEN zapremina_l < 200 THEN '{fixed.SIZE_SMALL}'
WHEN zapremina_l <= 400 THEN '{fixed.SIZE_MEDIUM}' ELSE '{fixed.SIZE_LARGE}' END AS velicina,
count(*) AS broj_proizvoda, {_money_mean(0)} AS prosecna_cena
FROM catalogue WHERE kategorija = 'ECONOMY' AND zapremina_l IS NOT NULL GROUP BY 1""",
}

SQL = {name: f"WITH {b.CATALOGUE_SQL} {sql}" for name, sql in _SQL.items()}
