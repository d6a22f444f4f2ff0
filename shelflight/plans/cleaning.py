"""Queries over cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import ordinal_code
from shelflight.operators import clean
from shelflight.plans import bindings as b
from shelflight.roles import Roles
from shelflight.session import work_path

RANGES = {"kapacitet_kg": (2, 10), "zapremina_l": (100, 500), "snaga_w": (500, 4000), "dijagonala_inch": (24, 60)}
PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
ORDERS = ["o_orderkey", "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS o_orderstatus",
          "CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS o_totalprice"]
MESSY = "CASE p_partkey % 3 WHEN 0 THEN '  ' || lower(p_brand) WHEN 1 THEN p_brand || chr(9) ELSE p_brand END"
PRIORITY = "CASE WHEN o_orderkey % 8 = 0 THEN ' ' || lower(o_orderpriority) || ' ' WHEN o_orderkey % 9 = 0 THEN 'nan' ELSE o_orderpriority END"
RULES = clean.CleanRules(min_filled=1)


def _cleaned(s, d):
    return clean.clean(b.raw_offers(s, d), Roles(), RULES)


QUERIES = {
    "c1_required": lambda s, d: clean.require(
        b.table(s, d, "orders").selectExpr(*ORDERS), ["o_orderstatus", "o_totalprice"]),
    "c2_positive_price": lambda s, d: clean.positive(b.table(s, d, "customer"), "c_acctbal").select(
        "c_custkey", "c_acctbal"),
    "c3_normal_brand": lambda s, d: clean.with_normal_brand(
        b.table(s, d, "part").selectExpr("p_partkey", f"{MESSY} AS brend"), "brend"),
    "c4_clamp_to_null": lambda s, d: clean.clamp_to_null(b.catalogue(s, d), RANGES).select("id", *RANGES),
    "c5_min_filled": lambda s, d: clean.min_filled(b.raw_offers(s, d), Roles().optional, 3).select(
        "id", *Roles().optional),
    "c6_keep_latest": lambda s, d: clean.keep_latest(b.table(s, d, "events"), "user_id", ["ts", "event_id"]),
    "c7_tukey_filter": lambda s, d: clean.tukey_filter(b.table(s, d, "events"), "value", 1.0).select(
        "event_id", "value"),
    "c7_tukey_by_group": lambda s, d: clean.tukey_filter(
        b.table(s, d, "events"), "value", by=["event_type"]).select("event_id", "event_type", "value"),
    "c8_ordinal_code": lambda s, d: b.table(s, d, "orders").selectExpr("o_orderkey", f"{PRIORITY} AS oznaka").select(
        "o_orderkey", "oznaka", ordinal_code(F.col("oznaka"), PRIORITIES).cast("double").alias("kod")),
    "c9_cleaning_report": lambda s, d: b.rounded(
        clean.cleaning_report(b.raw_offers(s, d), _cleaned(s, d)), 6, "dropped_pct"),
    "c9_dropped_by_rule": lambda s, d: b.rounded(clean.clean_with_report(
        b.raw_offers(s, d), work_path(s, "clean"), Roles(), RULES), 6, "dropped_pct"),
    "c10_clean": lambda s, d: b.plain_nulls(_cleaned(s, d)),
}

_CLAMPED = ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in
                     fixed.TECHNICAL_RANGES.items())
_FILLED = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in Roles().optional)
_CLEAN = f"""{b.RAW_OFFERS_SQL},
conformed AS (SELECT * REPLACE (upper(trim(brend)) AS brend, {_CLAMPED}) FROM raw_offers
    WHERE naziv IS NOT NULL AND brend IS NOT NULL AND kategorija IS NOT NULL AND cena > 0),
latest AS (SELECT * FROM conformed WHERE {_FILLED} >= 1
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY datum_preuzimanja DESC, id DESC) = 1),
q AS (SELECT quantile_cont(cena, 0.25) AS q1, quantile_cont(cena, 0.75) AS q3 FROM latest),
cleaned AS (SELECT l.*, {b.grade_code_sql('energetska_klasa')} AS energetska_klasa_num FROM latest l, q
    WHERE cena >= greatest(q1 - 1.5 * (q3 - q1), 1000) AND cena <= q3 + 1.5 * (q3 - q1))"""

SQL = {
    "c1_required": f"""SELECT * FROM (SELECT {', '.join(ORDERS)} FROM orders)
WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL""",
    "c2_positive_price": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
    "c3_normal_brand": "SELECT p_partkey, upper(p_brand) AS brend FROM part",
    "c4_clamp_to_null": f"WITH {b.CATALOGUE_SQL} SELECT id, " + ", ".join(
        f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in RANGES.items())
        + " FROM catalogue",
    "c5_min_filled": f"""WITH {b.RAW_OFFERS_SQL} SELECT id, {', '.join(Roles().optional)} FROM raw_offers
WHERE {_FILLED} >= 3""",
    "c6_keep_latest": """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "c7_tukey_filter": """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q
WHERE value BETWEEN greatest(q1 - 1.5 * (q3 - q1), 1.0) AND q3 + 1.5 * (q3 - q1)""",
    "c7_tukey_by_group": """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1,
quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, e.value FROM events e JOIN q USING (event_type)
WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
    "c8_ordinal_code": f"""SELECT o_orderkey, oznaka, 1.0::DOUBLE * CASE upper(trim(oznaka)) """ + " ".join(
        f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES, 1))
        + f" END AS kod FROM (SELECT o_orderkey, {PRIORITY} AS oznaka FROM orders)",
    "c9_cleaning_report": f"""WITH {_CLEAN},
n AS (SELECT (SELECT count(*) FROM raw_offers) AS before, (SELECT count(*) FROM cleaned) AS after)
SELECT before, after, before - after AS dropped, round(100.0 * (before - after) / before, 6) AS dropped_pct,
       after < {fixed.MIN_CLEAN_ROWS} AS too_few FROM n""",
    "c9_dropped_by_rule": f"""WITH {_CLEAN},
r AS (SELECT naziv IS NOT NULL AND brend IS NOT NULL AND kategorija IS NOT NULL AND cena IS NOT NULL AS named, coalesce(cena > 0, false) AS priced FROM raw_offers),
n AS (SELECT count(*) AS before, count(*) FILTER (NOT named) AS bez_obaveznih, count(*) FILTER (named AND NOT priced) AS bez_cene FROM r),
m AS (SELECT (SELECT count(*) FROM conformed) AS c, (SELECT count(*) FROM conformed WHERE {_FILLED} >= 1) AS f,
      (SELECT count(*) FROM latest) AS l, (SELECT count(*) FROM cleaned) AS after)
SELECT before, after, before - after AS dropped, round(100.0 * (before - after) / before, 6) AS dropped_pct, after < {fixed.MIN_CLEAN_ROWS} AS too_few,
       bez_obaveznih, bez_cene, c - f AS bez_podataka, f - l AS ponovljeni, l - after AS van_granica FROM n, m""",
    "c10_clean": f"WITH {_CLEAN} SELECT * REPLACE ({b.FLAG_SQL}, {b.CODE_SQL}) FROM cleaned",
}
