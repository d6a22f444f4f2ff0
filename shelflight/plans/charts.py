"""Queries over chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import price_band
from shelflight.operators import charts, clustering
from shelflight.plans import bindings as b
from shelflight.plans.models import COST_SQL, descent_sql, line_model
from shelflight.roles import Roles

ORDER_PRICE = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS cena"
#: Rows of returned and kept items; some without a price, which still count as rows of their group.
LINE_ROLES = Roles(category="l_returnflag", price="cena")
LINE_PRICE = "CASE WHEN l_quantity = 7 THEN NULL ELSE l_extendedprice END AS cena"
CENTRES = [[0.1, 0.05], [0.3, 0.2], [0.5, 0.45]]
POINT_WEIGHTS = {"cena": 60, "snaga_w": 40}


def _orders(s, d):
    return b.table(s, d, "orders").selectExpr("o_orderkey", ORDER_PRICE)


def _boxes(s, d):
    y = b.table(s, d, "lineitem").selectExpr("l_returnflag", LINE_PRICE)
    return b.rounded(charts.box_stats(y, LINE_ROLES), 8, "donji_brk", "q1", "medijana", "q3", "gornji_brk")


def _labelled(s, d):
    space = clustering.feature_space(b.catalogue(s, d), POINT_WEIGHTS)
    return clustering.assign(space, clustering.feature_columns(POINT_WEIGHTS), CENTRES)


def _curve(s, d):
    curve = charts.learning_curve(line_model(s, d, steps=100).history(s))
    return b.rounded(curve, 2, "trosak").withColumn("log10_trosak", F.round("log10_trosak", 9))


def _predicted(s, d):
    scored = b.table(s, d, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderkey") * 3.0 + 5000).alias("p"))
    return charts.predicted_vs_actual(scored, "o_totalprice", "p", "o_orderkey")


#: The bands with two more: one above every price, and the last for prices that are missing.
EXTENDED_BANDS = [*fixed.PRICE_BANDS[:-1], (10**9, "do milijarde"), (2 * 10**9, "do dve milijarde"), fixed.PRICE_BANDS[-1]]


def _histogram(s, d):
    rows = b.table(s, d, "lineitem").select(F.col("l_linenumber").alias("klaster"), "l_extendedprice")
    return b.rounded(charts.cluster_histogram(rows, "l_extendedprice"), 6, "od", "do")


QUERIES = {
    "e1_top_brands": lambda s, d: charts.value_counts(b.catalogue(s, d), "brend", 10),
    "e1_grades": lambda s, d: charts.value_counts(b.catalogue(s, d), "energetska_klasa"),
    "e2_share_table": lambda s, d: b.rounded(charts.share_table(
        charts.value_counts(b.catalogue(s, d), "brend"), "brend"), 6, "procenat"),
    "e3_price_bands": lambda s, d: _orders(s, d).select("o_orderkey", price_band(F.col("cena")).alias("opseg")),
    "e4_band_histogram": lambda s, d: charts.band_histogram(_orders(s, d), bands=EXTENDED_BANDS),
    "e5_scatter": lambda s, d: charts.scatter(b.catalogue(s, d), "zapremina_l", ["ECONOMY", "LARGE", "PROMO"]),
    "e5_grid_pyramid": lambda s, d: charts.grid_pyramid(b.table(s, d, "lineitem"), "l_quantity", "l_extendedprice"),
    "e6_scatter_one_category": lambda s, d: charts.scatter(b.catalogue(s, d), "dijagonala_inch", ["PROMO"]),
    "e7_box_stats": _boxes,
    "e8_learning_curve": _curve,
    "e9_predicted_vs_actual": _predicted,
    "e10_cluster_centres": lambda s, d: b.rounded(
        charts.cluster_centres(_labelled(s, d), ["cena", "snaga_w"]), 7, "sredina_cena", "sredina_snaga_w"),
    "e10_cluster_scatter": lambda s, d: charts.cluster_scatter(_labelled(s, d), "cena", "snaga_w"),
    "e11_cluster_histogram": _histogram,
}


def band_sql(value: str, bands=fixed.PRICE_BANDS) -> str:
    arms = " ".join(f"WHEN {value} <= {edge} THEN '{label}'" for edge, label in bands[:-1])
    return f"CASE {arms} ELSE '{bands[-1][1]}' END"


def space_sql(weights: dict[str, float], source: str = "catalogue") -> str:
    """CTEs ``rows_`` (complete rows) and ``space`` with the weighted features."""
    columns = list(weights)
    full = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in columns)
    feats = ", ".join(f"CASE WHEN hi_{c} <> lo_{c} THEN ({c} - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0 END * {w / 100.0} AS f_{c}"
                      for c, w in weights.items())
    return (f"rows_ AS (SELECT * FROM {source} WHERE {full}), ends AS (SELECT {ends} FROM rows_), "
            f"space AS (SELECT rows_.*, {feats} FROM rows_, ends)")


def label_sql(features: list[str], centres: list[list[float]]) -> str:
    """Index of the nearest fixed centre, the lowest on ties."""
    d = [" + ".join(f"({f} - {c!r}) * ({f} - {c!r})" for f, c in zip(features, centre)) for centre in centres]
    return f"list_position([{', '.join(d)}], list_min([{', '.join(d)}])) - 1"


LABELLED_SQL = (f"{b.CATALOGUE_SQL}, {space_sql(POINT_WEIGHTS)}, labelled AS (SELECT *, "
                f"{label_sql(['f_cena', 'f_snaga_w'], CENTRES)} AS klaster FROM space)")

_CAT = f"WITH {b.CATALOGUE_SQL} "
_ORD = f"WITH o AS (SELECT o_orderkey, {ORDER_PRICE} FROM orders) "
_axis = ", ".join(f"({i}, '{label}')" for i, (_, label) in enumerate(EXTENDED_BANDS))

SQL = {
    "e1_top_brands": _CAT + "SELECT brend, count(*) AS broj FROM catalogue GROUP BY brend ORDER BY broj DESC, brend LIMIT 10",
    "e1_grades": _CAT + """SELECT energetska_klasa, count(*) AS broj FROM catalogue
WHERE energetska_klasa IS NOT NULL GROUP BY energetska_klasa""",
    "e2_share_table": _CAT + f""", c AS (SELECT brend, count(*) AS broj, row_number() OVER
(ORDER BY count(*) DESC, brend) AS r FROM catalogue GROUP BY brend),
t AS (SELECT CASE WHEN r <= 10 THEN brend ELSE '{fixed.REMAINDER}' END AS brend, CAST(sum(broj) AS BIGINT) AS broj
FROM c GROUP BY 1), p AS (SELECT brend, broj, 100.0 * broj / sum(broj) OVER () AS p FROM t)
SELECT brend, broj, round(p, 6) AS procenat, CASE WHEN p >= 3 THEN printf('%.1f', p) || '%' ELSE '' END AS natpis FROM p""",
    "e3_price_bands": _ORD + f"SELECT o_orderkey, {band_sql('cena')} AS opseg FROM o",
    "e4_band_histogram": _ORD + f""", a(redosled, opseg) AS (VALUES {_axis}),
n AS (SELECT {band_sql('cena', EXTENDED_BANDS)} AS opseg, count(*) AS broj FROM o GROUP BY 1)
SELECT redosled, a.opseg, coalesce(broj, 0) AS broj FROM a LEFT JOIN n ON a.opseg = n.opseg""",
    "e5_scatter": _CAT + """SELECT id, kategorija, zapremina_l AS x, cena / 1000 AS y FROM catalogue
WHERE kategorija IN ('ECONOMY', 'LARGE', 'PROMO') AND zapremina_l IS NOT NULL AND cena IS NOT NULL""",
    "e5_grid_pyramid": """WITH p AS (SELECT l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y FROM lineitem),
e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p),
n AS (SELECT unnest(range(0, 7)) AS nivo), s AS (SELECT nivo, 1 << nivo AS m FROM n)
SELECT nivo, least(floor((x - x0) / (x1 - x0) * m), m - 1)::INT AS kx, least(floor((y - y0) / (y1 - y0) * m), m - 1)::INT AS ky,
count(*) AS broj FROM p, e, s GROUP BY ALL""",
    "e6_scatter_one_category": _CAT + """SELECT id, kategorija, dijagonala_inch AS x, cena / 1000 AS y FROM catalogue
WHERE kategorija = 'PROMO' AND dijagonala_inch IS NOT NULL AND cena IS NOT NULL""",
    "e7_box_stats": f"""WITH y AS (SELECT l_returnflag, y / 1000 AS y FROM
(SELECT l_returnflag, {LINE_PRICE.replace(' AS cena', ' AS y')} FROM lineitem)),
q AS (SELECT l_returnflag, count(*) AS redova, count(y) AS n, quantile_cont(y, 0.25) AS q1,
quantile_cont(y, 0.5) AS medijana, quantile_cont(y, 0.75) AS q3 FROM y GROUP BY l_returnflag HAVING count(*) >= 10)
SELECT q.l_returnflag, any_value(redova) AS redova, any_value(n) AS n, round(any_value(q1), 8) AS q1,
round(any_value(medijana), 8) AS medijana, round(any_value(q3), 8) AS q3,
round(least(any_value(q1), min(y) FILTER (WHERE y >= q1 - 1.5 * (q3 - q1))), 8) AS donji_brk,
round(greatest(any_value(q3), max(y) FILTER (WHERE y <= q3 + 1.5 * (q3 - q1))), 8) AS gornji_brk,
count(*) FILTER (WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)) AS izvan
FROM q JOIN y ON q.l_returnflag = y.l_returnflag GROUP BY q.l_returnflag""",
    "e8_learning_curve": f"""WITH {descent_sql(100)}, k AS (SELECT n - 1 AS iteracija, {COST_SQL} AS t
FROM g, a, c, yy WHERE n > 0) SELECT iteracija, round(t, 2) AS trosak, round(log10(t), 9) AS log10_trosak FROM k""",
    "e9_predicted_vs_actual": """WITH p AS (SELECT o_orderkey, o_totalprice / 1000 AS stvarno,
(o_orderkey * 3.0::DOUBLE + 5000) / 1000 AS predvidjeno FROM orders)
SELECT *, (SELECT least(min(stvarno), min(predvidjeno)) FROM p) AS osa_od,
(SELECT greatest(max(stvarno), max(predvidjeno)) FROM p) AS osa_do FROM p""",
    "e10_cluster_centres": f"""WITH {LABELLED_SQL} SELECT klaster, count(*) AS broj, round(avg(cena), 7) AS sredina_cena,
round(avg(snaga_w), 7) AS sredina_snaga_w FROM labelled GROUP BY klaster""",
    "e10_cluster_scatter": f"WITH {LABELLED_SQL} SELECT id, klaster, cena AS x, snaga_w AS y FROM labelled",
    "e11_cluster_histogram": """WITH v AS (SELECT l_linenumber AS klaster, l_extendedprice AS v FROM lineitem),
s AS (SELECT klaster, min(v) AS lo, max(v) AS hi FROM v GROUP BY klaster),
c AS (SELECT klaster, least(CAST(floor((v - lo) / (hi - lo) * 20) AS INT), 19) AS deo, count(*) AS broj
FROM v JOIN s USING (klaster) GROUP BY 1, 2),
a AS (SELECT klaster, lo, hi, unnest(range(20)) AS deo FROM s)
SELECT a.klaster, a.deo, round(lo + a.deo * ((hi - lo) / 20), 6) AS od,
round(lo + (a.deo + 1) * ((hi - lo) / 20), 6) AS do, coalesce(broj, 0) AS broj
FROM a LEFT JOIN c ON a.klaster = c.klaster AND a.deo = c.deo""",
}
