"""Queries over clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import silhouette_verdict
from shelflight.operators import clustering
from shelflight.plans import bindings as b
from shelflight.plans.charts import CENTRES, LABELLED_SQL, POINT_WEIGHTS, label_sql, space_sql
from shelflight.session import small_table

FEATURES = clustering.feature_columns(POINT_WEIGHTS)
_, PRESET_K, PRESET = fixed.CLUSTER_PRESETS[1]
ROUNDS = 3


def _space(s, d):
    return clustering.feature_space(b.catalogue(s, d), POINT_WEIGHTS)


def _features(s, d):
    space = clustering.feature_space(b.catalogue(s, d), PRESET, PRESET_K)
    names = clustering.feature_columns(PRESET)
    return b.rounded(space.select("id", *names), 9, *names)


def _seeds(s, d):
    space = _space(s, d)
    found = clustering.seed_centroids(space, FEATURES, 4)
    rows = [(i, *[round(v, 9) for v in c]) for i, c in enumerate(found)]
    return small_table(s, rows, "redosled int, x double, y double")


def _lloyd(s, d):
    found = clustering.lloyd(_space(s, d), FEATURES, CENTRES, rounds=ROUNDS, tolerance=0.0)
    rows = [(i, *[round(v, 9) for v in c]) for i, c in enumerate(found)]
    return small_table(s, rows, "klaster int, x double, y double")


def _k_means(weights, k):
    """Profiles of the clusters of a preset."""
    def query(s, d):
        labelled, _ = clustering.k_means(b.catalogue(s, d), weights, k)
        return clustering.cluster_profile(labelled, list(weights))

    return query


def _assign(s, d):
    return clustering.assign(_space(s, d), FEATURES, CENTRES).select("id", "klaster")


def _assign_vectors(s, d):
    """Nearest label mean of every vector."""
    vectors = b.table(s, d, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    means = (vectors.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i")
             .agg(F.round(F.avg("v"), 6).alias("m")).groupBy("label")
             .agg(F.sort_array(F.collect_list(F.struct("i", "m")))["m"].alias("m")).orderBy("label").collect())
    return clustering.assign_vectors(vectors, "embedding", [r["m"] for r in means]).select("vec_id", "klaster")


def _silhouette(s, d):
    labelled = clustering.assign(_space(s, d), FEATURES, CENTRES)
    return b.rounded(clustering.silhouette(labelled, FEATURES), 8, "skor")


def _verdict(s, d):
    scored = b.table(s, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000).alias("skor"))
    return scored.select("o_orderkey", silhouette_verdict(F.col("skor")).alias("verdikt"))


def _profile(s, d):
    labelled = clustering.assign(_space(s, d), FEATURES, CENTRES)
    columns = ["snaga_w", "energetska_klasa_num", "zapremina_l", "kapacitet_kg", "dijagonala_inch", "id"]
    return clustering.cluster_profile(labelled, columns)


QUERIES = {
    "h1_feature_space": _features,
    "h2_seed_centroids": _seeds,
    "h3_lloyd_rounds": _lloyd,
    "h3_k_means": _k_means(PRESET, PRESET_K),
    "h3_k_means_first_preset": _k_means(*reversed(fixed.CLUSTER_PRESETS[0][1:])),
    "h3_k_means_third_preset": _k_means(*reversed(fixed.CLUSTER_PRESETS[2][1:])),
    "h3_k_means_default": _k_means(fixed.CLUSTER_DEFAULT, fixed.CLUSTER_DEFAULT_K),
    "h4_assign": _assign,
    "h4_assign_vectors": _assign_vectors,
    "h5_silhouette": _silhouette,
    "h6_verdict": _verdict,
    "h7_cluster_profile": _profile,
}


def _rounds_sql() -> str:
    """One CTE pair per round: labels against the last centres, then the means."""
    first = " UNION ALL ".join(f"SELECT {i} AS k, {x!r}::DOUBLE AS x, {y!r}::DOUBLE AS y" for i, (x, y) in enumerate(CENTRES))
    out = [f"c0 AS ({first})"]
    for r in range(ROUNDS):
        out.append(f"""l{r + 1} AS (SELECT id, f_cena, f_snaga_w, arg_min(k, (d, k)) AS k FROM (SELECT s.id, f_cena, f_snaga_w, c.k,
(f_cena - x) * (f_cena - x) + (f_snaga_w - y) * (f_snaga_w - y) AS d FROM space s, c{r} c) GROUP BY ALL),
c{r + 1} AS (SELECT c.k, coalesce(avg(f_cena), any_value(c.x)) AS x, coalesce(avg(f_snaga_w), any_value(c.y)) AS y
FROM c{r} c LEFT JOIN l{r + 1} l ON l.k = c.k GROUP BY c.k)""")
    return ", ".join(out)


def seeds_sql(features: list[str], k: int, seed: int = 42) -> str:
    """CTEs ``s0`` to ``s<k-1>``: each centre drawn with weight by squared distance to those before."""
    out = []
    for step in range(k):
        u = f"({b.draw_sql('id', seed, step)} + 0.5) / {float(1 << 52)!r}"
        away = [" + ".join(f"(f.{c} - s{j}.{c}) * (f.{c} - s{j}.{c})" for c in features) for j in range(step)]
        near = f"least({', '.join(away)})" if away else "1.0::DOUBLE"
        sources = ", ".join(["space f", *[f"s{j}" for j in range(step)]])
        out.append(f"""s{step} AS MATERIALIZED (SELECT {', '.join(features)} FROM (SELECT f.id, {', '.join(f'f.{c}' for c in features)}, {near} AS d, -ln({u.replace('id ||', 'f.id ||')}) AS w FROM {sources})
ORDER BY d <= 0, CASE WHEN d > 0 THEN w / d ELSE w END, id LIMIT 1)""")
    return ", ".join(out)


def k_means_sql(weights: dict[str, float], k: int) -> str:
    """CTEs up to ``labelled``: seeds, rounds until the centres rest, labels."""
    features = [f"f_{c}" for c in weights]
    start = "[" + ", ".join(f"(SELECT [{', '.join(features)}] FROM s{i})" for i in range(k)) + "]"
    row = "[" + ", ".join(features) + "]"
    away = f"list_transform(c, lambda o: list_sum(list_transform(range(1, {len(features) + 1}), lambda i: ({row}[i] - o[i]) * ({row}[i] - o[i]))))"
    means = ", ".join(f"coalesce(avg({f}) FILTER (WHERE l = j), any_value(c[j][{i + 1}]))" for i, f in enumerate(features))
    return f"""RECURSIVE {b.CATALOGUE_SQL}, {space_sql(weights)}, {seeds_sql(features, k)},
r AS (SELECT 0 AS n, {start} AS c, 1e9::DOUBLE AS s
      UNION ALL SELECT n + 1, list(m ORDER BY j), sum(list_sum(list_transform(range(1, {len(features) + 1}), lambda i: (m[i] - o[i]) * (m[i] - o[i]))))
      FROM (SELECT n, j, [{means}] AS m, any_value(c[j]) AS o
            FROM (SELECT n, c, {', '.join(features)}, list_position({away}, list_min({away})) AS l FROM r, space WHERE s >= 1e-4 AND n < 300) p,
            (SELECT unnest(range(1, {k + 1})) AS j) t GROUP BY n, j) q GROUP BY n),
e AS (SELECT c FROM r ORDER BY n DESC LIMIT 1),
labelled AS (SELECT space.*, list_position({away}, list_min({away})) - 1 AS klaster FROM space, e)"""


def profile_sql(weights: dict[str, float], k: int) -> str:
    columns = ["cena", *[c for c in weights if c != "cena"]]
    return (f"WITH {k_means_sql(weights, k)} SELECT klaster, count(*) AS broj, concat_ws(', ', "
            + ", ".join(_text_sql(c) for c in columns) + ") AS opis FROM labelled GROUP BY klaster")


def _number(mean: str, digits: int) -> str:
    return f"printf('%.{digits}f', {mean})"


def _text_sql(column: str) -> str:
    mean = f"avg({column})"
    if column == "cena":
        shown = f"'prosečna cena ≈ ' || format('{{:,}}', CAST({_number(mean, 0)} AS BIGINT)) || ' RSD'"
    elif column == "energetska_klasa_num":
        shown = (f"CASE WHEN {mean} >= 6 THEN 'bolje energ. klase (' ELSE 'lošije energ. klase (' END || "
                 f"{_number(mean, 1)} || '/10)'")
    elif column in fixed.CLUSTER_TEXTS:
        before, digits, _, after = fixed.CLUSTER_TEXTS[column]
        shown = f"'{before}' || {_number(mean, digits)} || '{after}'"
    else:
        shown = f"'{column} ≈ ' || {_number(mean, 1)}"
    return shown


SQL = {
    "h1_feature_space": f"""WITH {b.CATALOGUE_SQL}, {space_sql(PRESET)}
SELECT id, {', '.join(f'round(f_{c}, 9) AS f_{c}' for c in PRESET)} FROM space""",
    "h2_seed_centroids": f"""WITH {b.CATALOGUE_SQL}, {space_sql(POINT_WEIGHTS)}, {seeds_sql(FEATURES, 4)}
""" + " UNION ALL ".join(f"SELECT {i} AS redosled, round(f_cena, 9) AS x, round(f_snaga_w, 9) AS y FROM s{i}" for i in range(4)),
    "h3_k_means": profile_sql(PRESET, PRESET_K),
    "h3_k_means_first_preset": profile_sql(*reversed(fixed.CLUSTER_PRESETS[0][1:])),
    "h3_k_means_third_preset": profile_sql(*reversed(fixed.CLUSTER_PRESETS[2][1:])),
    "h3_k_means_default": profile_sql(fixed.CLUSTER_DEFAULT, fixed.CLUSTER_DEFAULT_K),
    "h3_lloyd_rounds": f"""WITH {b.CATALOGUE_SQL}, {space_sql(POINT_WEIGHTS)}, {_rounds_sql()}
SELECT k AS klaster, round(x, 9) AS x, round(y, 9) AS y FROM c{ROUNDS}""",
    "h4_assign": f"WITH {LABELLED_SQL} SELECT id, klaster FROM labelled",
    "h4_assign_vectors": """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, round(avg(v), 6) AS m FROM e GROUP BY label, i),
n AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS k FROM (SELECT DISTINCT label FROM e)),
d AS (SELECT e.vec_id, n.k, sum((e.v - m.m) * (e.v - m.m)) AS d FROM e JOIN m USING (i) JOIN n ON n.label = m.label
GROUP BY e.vec_id, n.k)
SELECT vec_id, arg_min(k, (d, k)) AS klaster FROM d GROUP BY vec_id""",
    "h5_silhouette": f"""WITH {LABELLED_SQL},
n AS (SELECT klaster, count(*) AS n FROM labelled GROUP BY klaster),
p AS (SELECT a.id, a.klaster AS own, c.klaster AS other, sum(sqrt((a.f_cena - c.f_cena) * (a.f_cena - c.f_cena)
+ (a.f_snaga_w - c.f_snaga_w) * (a.f_snaga_w - c.f_snaga_w))) AS t FROM labelled a, labelled c GROUP BY 1, 2, 3),
s AS (SELECT p.id, max(CASE WHEN other = own THEN CASE WHEN n.n > 1 THEN t / (n.n - 1) ELSE 0 END END) AS a,
min(CASE WHEN other <> own THEN t / n.n END) AS b FROM p JOIN n ON n.klaster = p.other GROUP BY p.id),
r AS (SELECT avg(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS skor FROM s)
SELECT round(skor, 8) AS skor, CASE WHEN skor > 0.5 THEN 'dobar' WHEN skor > 0.25 THEN 'osrednji' ELSE 'los' END AS verdikt
FROM r""",
    "h6_verdict": """SELECT o_orderkey, CASE WHEN o_totalprice / 500000 > 0.5 THEN 'dobar'
WHEN o_totalprice / 500000 > 0.25 THEN 'osrednji' ELSE 'los' END AS verdikt FROM orders""",
    "h7_cluster_profile": f"""WITH {LABELLED_SQL} SELECT klaster, count(*) AS broj, concat_ws(', ', """ + ", ".join(
        _text_sql(c) for c in ["cena", "snaga_w", "energetska_klasa_num", "zapremina_l", "kapacitet_kg",
                               "dijagonala_inch", "id"]) + ") AS opis FROM labelled GROUP BY klaster",
}
