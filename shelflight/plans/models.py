"""Queries over scaling, regression and estimates."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions import scaling
from shelflight.operators import regression
from shelflight.plans import bindings as b
from shelflight.roles import Roles
from shelflight.session import small_table, work_path

#: Line items as model rows; the discount is sometimes missing, so that it is imputed.
LINES = {
    "l_extendedprice": "l_extendedprice", "l_quantity": "l_quantity", "l_tax": "l_tax",
    "l_discount": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END",
    "l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus",
}
NUMBERS = ["l_quantity", "l_discount", "l_tax"]
LABELS = ["l_returnflag", "l_linestatus"]


def lines(s, d):
    return b.table(s, d, "lineitem").selectExpr(*b.select(LINES))


def line_model(s, d, steps=300):
    rows = lines(s, d)
    design = regression.fit_design(rows, "l_extendedprice", NUMBERS, LABELS)
    return regression.fit(rows, design, rate=0.1, steps=steps)


def _scaled(scale, s, d):
    out = scale(b.catalogue(s, d).withColumn("konstanta", F.lit(5.0)), ["cena", "zapremina_l", "konstanta"], "_s")
    return b.rounded(out.select("id", "cena_s", "zapremina_l_s", "konstanta_s"), 9, "cena_s", "zapremina_l_s")


def _design(s, d):
    rows = b.catalogue(s, d)
    matrix = regression.design_matrix(rows, regression.catalogue_design(rows))
    return b.rounded(matrix, 6, "vrednost").where("vrednost <> 0")


def _fit_one(s, d):
    """With one feature the descent ends at the least-squares line."""
    rows = lines(s, d)
    design = regression.fit_design(rows, "l_extendedprice", ["l_quantity"])
    model = regression.fit(rows, design, rate=0.5, steps=200)
    return small_table(s, [(round(model.weights["l_quantity"], 4), round(model.bias, 4))], "nagib double, odsecak double")


def _fit_lines(s, d):
    model = line_model(s, d)
    rows = [(n, round(w, 4)) for n, w in [*model.weights.items(), ("b", model.bias)]]
    return small_table(s, rows, "osobina string, tezina double")


def _costs(s, d):
    """The cost of every step; the SQL gives the same falling row."""
    return b.rounded(line_model(s, d).history(s), 2, "trosak")


#: A model with given weights, so that predictions can be checked line by line.
FIXED = regression.LinearModel(
    regression.Design("l_extendedprice", ("l_quantity", "l_tax"), ("l_returnflag",),
                      {"l_quantity": 25.0, "l_tax": 0.04}, {"l_quantity": 20.0, "l_tax": 0.05},
                      {"l_quantity": 10.0, "l_tax": 0.0}, {"l_returnflag": ("A", "N", "R")}, 0.0),
    {"l_quantity": 14000.0, "l_tax": 7.0, "l_returnflag_N": 250.0, "l_returnflag_R": -125.5}, 38000.25)


def _predict(s, d):
    return FIXED.predict(lines(s, d)).select("l_quantity", "l_returnflag", "predikcija")


def _metrics(s, d):
    return b.rounded(regression.evaluate(FIXED.predict(lines(s, d)), "l_extendedprice", "predikcija"), 6, "r2", "rmse")


def _split(s, d):
    part, held_out = regression.split(b.table(s, d, "orders"), "o_orderkey")
    return part.select("o_orderkey", F.lit(1).alias("obuka")).unionByName(held_out.select("o_orderkey", F.lit(0).alias("obuka")))


def _train(s, d, **options):
    return b.rounded(regression.train(b.catalogue(s, d), **options).metrics(), 4, "r2", "rmse")


def _scored(s, d):
    """Actual and predicted prices of the rows that training left out."""
    from shelflight.operators import charts

    points = charts.predicted_vs_actual(regression.train(b.catalogue(s, d)).scored(), "cena", "predikcija")
    return b.rounded(points, 5, "stvarno", "predvidjeno", "osa_od", "osa_do")


def _estimate(s, d, stored=False):
    """The sample inputs, typed in for the first brand of every category; ``stored`` saves and loads the model first."""
    rows = b.catalogue(s, d)
    model = regression.train(rows, steps=500).model
    if stored:
        path = work_path(s, "model")
        model.save(s, path)
        model = regression.LinearModel.load(s, path)
    known = rows.groupBy("kategorija").agg(F.lower(F.min("brend")).alias("brend"))
    typed = F.from_json(F.lit(json.dumps(fixed.ESTIMATE_SAMPLES)), "array<map<string,string>>")
    wanted = known.withColumn("uzorak", F.explode(typed))
    items = wanted.select("kategorija", "brend", *[
        F.col("uzorak")[c].alias(c) for c in model.design.numeric])
    found = regression.estimate(model, items).select("kategorija", "brend", *model.design.numeric, "predikcija")
    return b.rounded(found, 3, "predikcija")


QUERIES = {
    "g1_min_max": lambda s, d: _scaled(scaling.min_max, s, d),
    "g2_z_score": lambda s, d: _scaled(scaling.z_score, s, d),
    "g3_design_matrix": _design,
    "g4_fit_line": _fit_one,
    "g4_fit_weights": _fit_lines,
    "g4_cost_falls": _costs,
    "g5_predict": _predict,
    "g6_g7_metrics": _metrics,
    "g8_split": _split,
    "g9_train": _train,
    "g9_train_scaled_on_train": lambda s, d: _train(s, d, scale_on_train=True),
    "g10_estimate": _estimate,
    "g10_estimate_stored": lambda s, d: _estimate(s, d, stored=True),
    "e9_predicted_on_test": _scored,
}

_TECH = Roles().technical
_IMPUTED = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM catalogue)) AS {c}" for c in _TECH)
_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _TECH)
_LINES_SQL = f"lines AS (SELECT {', '.join(b.select(LINES))} FROM lineitem)"
_PREDICTED = ("38000.25 + 14000.0 * ((l_quantity - 20.0) / 10.0) + CASE l_returnflag WHEN 'N' THEN 250.0 "
              "WHEN 'R' THEN -125.5 ELSE 0 END")

#: The feature rows of the line model, each ending with 1 for the bias.
_LINE_NAMES = [*NUMBERS, "l_returnflag_N", "l_returnflag_R", "l_linestatus_O", "b"]
_LINE_FILLED = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM lines)) AS {c}" for c in NUMBERS)
_LINE_Z = ", ".join(f"({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_samp({c}) FROM f)" for c in NUMBERS)
_M = len(_LINE_NAMES)


def descent_sql(steps: int, rate: float = 0.1) -> str:
    """CTEs up to ``g``: weights ``w`` after each step ``n``, from the matrix of mean products."""
    return f"""RECURSIVE {_LINES_SQL},
f AS (SELECT l_extendedprice AS y, l_returnflag, l_linestatus, {_LINE_FILLED} FROM lines),
x AS (SELECT y, [{_LINE_Z}, (l_returnflag = 'N')::INT::DOUBLE, (l_returnflag = 'R')::INT::DOUBLE,
      (l_linestatus = 'O')::INT::DOUBLE, 1.0::DOUBLE] AS x FROM f),
p AS (SELECT i, j, avg(x[i] * x[j]) AS a FROM x, range(1, {_M + 1}) t(i), range(1, {_M + 1}) u(j) GROUP BY i, j),
a AS MATERIALIZED (SELECT list(r ORDER BY i) AS a FROM (SELECT i, list(a ORDER BY j) AS r FROM p GROUP BY i)),
c AS MATERIALIZED (SELECT list(c ORDER BY i) AS c FROM (SELECT i, avg(x[i] * y) AS c FROM x, range(1, {_M + 1}) t(i) GROUP BY i)),
yy AS (SELECT avg(y * y) AS yy FROM x),
g AS (SELECT 0 AS n, list_transform(range({_M}), lambda i: 0.0::DOUBLE) AS w
      UNION ALL SELECT n + 1, list_transform(range(1, {_M + 1}),
      lambda i: w[i] - {rate} * (list_dot_product(a[i], w) - c[i])) FROM g, a, c WHERE n < {steps})"""


#: Cost after a step from the same mean products.
COST_SQL = f"""(list_dot_product(w, list_transform(range(1, {_M + 1}), lambda i: list_dot_product(a[i], w)))
- 2 * list_dot_product(w, c) + yy) / 2"""

#: Typed inputs as rows of texts.
_SAMPLES = ", ".join("(" + ", ".join(f"'{sample[c]}'" for c in _TECH) + ")" for sample in fixed.ESTIMATE_SAMPLES)


def catalogue_fit_sql(steps: int, scaled: str = "priced", rate: float = 0.05) -> str:
    """CTEs up to ``last_`` (weights ``w``) and ``scored``: split, preparation from ``scaled``, descent over the train rows.

    Weights are those of the numbers, of all categories but the first, of all brands but the first, and the bias.
    """
    q = ", ".join(f"quantile_cont({c}, 0.5) AS q_{c}" for c in _TECH)
    st = ", ".join(f"any_value(q_{c}) AS q_{c}, avg(coalesce({c}, q_{c})) AS m_{c}, stddev_samp(coalesce({c}, q_{c})) AS s_{c}" for c in _TECH)
    z = ", ".join(f"coalesce((coalesce({c}, q_{c}) - m_{c}) / nullif(s_{c}, 0), 0)" for c in _TECH)
    return f"""RECURSIVE {b.CATALOGUE_SQL},
priced AS (SELECT *, row_number() OVER (ORDER BY {b.draw_sql('id', 42)}, id) <= floor(count(*) OVER () * 0.8) AS obuka
           FROM catalogue WHERE cena IS NOT NULL),
part_ AS (SELECT * FROM priced WHERE obuka),
qs AS (SELECT {q} FROM {scaled}), st AS MATERIALIZED (SELECT {st} FROM {scaled}, qs),
lv AS MATERIALIZED (SELECT list_sort(list(DISTINCT kategorija))[2:] AS kat, list_sort(list(DISTINCT brend))[2:] AS bre FROM {scaled}),
vec AS MATERIALIZED (SELECT id, cena, obuka, list_concat([{z}], list_transform(kat, lambda l: (l = kategorija)::INT::DOUBLE),
       list_transform(bre, lambda l: (l = brend)::INT::DOUBLE), [1.0::DOUBLE]) AS v FROM priced, st, lv),
dim AS (SELECT any_value(len(v)) AS m FROM vec),
pr AS (SELECT i, j, avg(v[i] * v[j]) AS a FROM vec, (SELECT unnest(range(1, m + 1)) AS i FROM dim), (SELECT unnest(range(1, m + 1)) AS j FROM dim)
       WHERE obuka GROUP BY i, j),
a AS MATERIALIZED (SELECT list(r ORDER BY i) AS a FROM (SELECT i, list(a ORDER BY j) AS r FROM pr GROUP BY i)),
c AS MATERIALIZED (SELECT list(c ORDER BY i) AS c FROM (SELECT i, avg(v[i] * cena) AS c FROM vec, (SELECT unnest(range(1, m + 1)) AS i FROM dim)
       WHERE obuka GROUP BY i)),
g AS (SELECT 0 AS n, list_transform(range(m), lambda i: 0.0::DOUBLE) AS w FROM dim
      UNION ALL SELECT n + 1, list_transform(range(1, len(w) + 1), lambda i: w[i] - {rate} * (list_dot_product(a[i], w) - c[i]))
      FROM g, a, c WHERE n < {steps}),
last_ AS MATERIALIZED (SELECT w FROM g WHERE n = {steps}),
scored AS (SELECT id, cena, obuka, list_dot_product(v, w) AS p FROM vec, last_)"""


METRICS_SQL = """, m AS (SELECT avg(cena) AS m FROM scored WHERE NOT obuka),
r AS (SELECT 1 - sum((cena - p) * (cena - p)) / sum((cena - m) * (cena - m)) AS r2, sqrt(avg((cena - p) * (cena - p))) AS rmse
      FROM scored, m WHERE NOT obuka)
SELECT round(r2, 4) AS r2, round(rmse, 4) AS rmse, CASE WHEN r2 > 0.5 THEN 'good' ELSE 'poor' END AS ocena FROM r"""

SQL = {
    "g4_fit_weights": f"""WITH {descent_sql(300)}
SELECT unnest({_LINE_NAMES}) AS osobina, unnest(list_transform(w, lambda v: round(v, 4))) AS tezina FROM g WHERE n = 300""",
    "g1_min_max": f"""WITH {b.CATALOGUE_SQL}
SELECT id, round((cena - min(cena) OVER ()) / (max(cena) OVER () - min(cena) OVER ()), 9) AS cena_s,
round((zapremina_l - min(zapremina_l) OVER ()) / (max(zapremina_l) OVER () - min(zapremina_l) OVER ()), 9)
AS zapremina_l_s, 0.0::DOUBLE AS konstanta_s FROM catalogue""",
    "g2_z_score": f"""WITH {b.CATALOGUE_SQL}
SELECT id, round((cena - avg(cena) OVER ()) / stddev_samp(cena) OVER (), 9) AS cena_s,
round((zapremina_l - avg(zapremina_l) OVER ()) / stddev_samp(zapremina_l) OVER (), 9)
AS zapremina_l_s, 0.0::DOUBLE AS konstanta_s FROM catalogue""",
    "g3_design_matrix": f"""WITH {b.CATALOGUE_SQL},
f AS (SELECT id, kategorija, brend, {_IMPUTED} FROM catalogue), s AS (SELECT {_STATS} FROM f),
e AS ({' UNION ALL '.join(f"SELECT id, '{c}' AS osobina, round(({c} - m_{c}) / s_{c}, 6) AS vrednost FROM f, s" for c in _TECH)}
UNION ALL SELECT id, 'kategorija_' || kategorija, 1 FROM f WHERE kategorija <> (SELECT min(kategorija) FROM f)
UNION ALL SELECT id, 'brend_' || brend, 1 FROM f WHERE brend <> (SELECT min(brend) FROM f))
SELECT id, osobina, vrednost FROM e WHERE vrednost <> 0""",
    "g4_fit_line": f"""WITH {_LINES_SQL},
z AS (SELECT l_extendedprice AS y, (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS x FROM lines)
SELECT round(regr_slope(y, x), 4) AS nagib, round(regr_intercept(y, x), 4) AS odsecak FROM z""",
    "g4_cost_falls": f"""WITH {descent_sql(300)}, k AS (SELECT n - 1 AS iteracija, {COST_SQL} AS t FROM g, a, c, yy WHERE n > 0)
SELECT iteracija, round(t, 2) AS trosak FROM k""",
    "g5_predict": f"WITH {_LINES_SQL} SELECT l_quantity, l_returnflag, {_PREDICTED} AS predikcija FROM lines",
    "g6_g7_metrics": f"""WITH {_LINES_SQL}, p AS (SELECT l_extendedprice AS y, {_PREDICTED} AS p FROM lines),
m AS (SELECT avg(y) AS m FROM p),
r AS (SELECT 1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)) AS r2, sqrt(avg((y - p) * (y - p))) AS rmse FROM p, m)
SELECT round(r2, 6) AS r2, round(rmse, 6) AS rmse, CASE WHEN r2 > 0.5 THEN 'good' ELSE 'poor' END AS ocena FROM r""",
    "g8_split": f"""SELECT o_orderkey, (row_number() OVER (ORDER BY {b.draw_sql('o_orderkey', 42)}, o_orderkey)
<= floor(count(*) OVER () * 0.8))::INT AS obuka FROM orders""",
    "g9_train": f"""WITH {catalogue_fit_sql(2000)}
{METRICS_SQL}""",
    "g9_train_scaled_on_train": f"""WITH {catalogue_fit_sql(2000, 'part_')}
{METRICS_SQL}""",
    "e9_predicted_on_test": f"""WITH {catalogue_fit_sql(2000)},
t AS (SELECT id, cena / 1000 AS stvarno, p / 1000 AS predvidjeno FROM scored WHERE NOT obuka)
SELECT id, round(stvarno, 5) AS stvarno, round(predvidjeno, 5) AS predvidjeno,
round((SELECT least(min(stvarno), min(predvidjeno)) FROM t), 5) AS osa_od,
round((SELECT greatest(max(stvarno), max(predvidjeno)) FROM t), 5) AS osa_do FROM t""",
    "g10_estimate": f"""WITH {catalogue_fit_sql(500)},
u AS (SELECT kategorija, lower(min(brend)) AS brend, upper(min(brend)) AS oznaka FROM catalogue GROUP BY kategorija),
s AS (SELECT * FROM u, (VALUES {_SAMPLES}) v({', '.join(_TECH)})),
n AS (SELECT s.*, {', '.join(f"coalesce((coalesce(TRY_CAST({c} AS DOUBLE), q_{c}) - m_{c}) / nullif(s_{c}, 0), 0) AS z_{c}" for c in _TECH)} FROM s, st),
x AS (SELECT *, list_concat([{', '.join('z_' + c for c in _TECH)}], list_transform(kat, lambda l: (l = kategorija)::INT::DOUBLE),
      list_transform(bre, lambda l: (l = oznaka)::INT::DOUBLE), [1.0::DOUBLE]) AS v FROM n, lv)
SELECT kategorija, oznaka AS brend, {', '.join(f'TRY_CAST({c} AS DOUBLE) AS {c}' for c in _TECH)}, round(list_dot_product(v, w), 3) AS predikcija
FROM x, last_""",
}
SQL["g10_estimate_stored"] = SQL["g10_estimate"]
