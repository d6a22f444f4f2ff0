from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.operators import clustering, tiles


def points(spark, x, n=4):
    rows = [(i, *map(float, p)) for i, p in enumerate(x)]
    names = [f"x{j}" for j in range(len(x[0]))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names)).repartition(n), names


def blobs(centres, size=40, spread=0.4, seed=0):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(c, spread, (size, 2)) for c in centres])


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i, own in enumerate(labels):
        mates = (labels == own).sum() - 1
        a = d[i][labels == own].sum() / mates if mates else 0.0
        b = min(d[i][labels == k].mean() for k in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


def test_separated_blobs(spark):
    x = blobs([(0, 0), (10, 0), (5, 8)])
    df, names = points(spark, x)
    start = clustering.seed_centroids(df, names, 3)
    found = clustering.lloyd(df, names, start)
    labelled = clustering.assign(df, names, found).orderBy("id").toPandas()
    groups = [set(labelled.klaster[i * 40:(i + 1) * 40]) for i in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    for centre, block in zip(found, [None] * 3):
        assert min(np.linalg.norm(np.array(centre) - c) for c in [(0, 0), (10, 0), (5, 8)]) < 0.3


def test_lloyd_rounds_like_numpy(spark):
    x = np.random.default_rng(3).random((150, 2))
    df, names = points(spark, x)
    start = x[:4].tolist() + [[50.0, 50.0]]  # the last one never gets a row and stays
    centroids = np.array(start)
    for _ in range(4):
        labels = np.argmin(((x[:, None] - centroids[None]) ** 2).sum(-1), axis=1)
        centroids = np.array([x[labels == i].mean(0) if (labels == i).any() else centroids[i] for i in range(5)])
    found = clustering.lloyd(df, names, start, rounds=4, tolerance=0.0)
    np.testing.assert_allclose(found, centroids, rtol=1e-12)
    assert found[4] == [50.0, 50.0]


def test_tie_goes_to_the_lowest_index(spark):
    df, names = points(spark, [[1.0, 0.0]])
    assert clustering.assign(df, names, [[2.0, 0.0], [0.0, 0.0]]).first().klaster == 0


def test_seeding(spark):
    x = blobs([(0, 0), (10, 0), (5, 8)], size=30)
    df, names = points(spark, x)
    first = clustering.seed_centroids(df, names, 3)
    assert first == clustering.seed_centroids(df.repartition(9), names, 3)
    assert first != clustering.seed_centroids(df, names, 3, seed=7)
    rows = {tuple(p) for p in x.tolist()}
    assert all(tuple(c) in rows for c in first) and len(set(map(tuple, first))) == 3
    same, names = points(spark, [[1.0, 1.0]] * 5)
    assert clustering.seed_centroids(same, names, 3) == [[1.0, 1.0]] * 3


def test_seeding_draws_by_squared_distance(spark):
    # After the first draw, the far point has nearly all the weight whatever the seed.
    x = [[0.0, 0.0]] * 1 + [[0.001 * i, 0.0] for i in range(1, 20)] + [[100.0, 100.0]]
    df, names = points(spark, x)
    for seed in range(4):
        assert [100.0, 100.0] in clustering.seed_centroids(df, names, 2, seed=seed)


@pytest.mark.parametrize("size", [8, 1000])
def test_silhouette_like_brute_force(spark, size):
    x = np.vstack([np.random.default_rng(8).random((60, 2)), [[0.5, 0.5]] * 30])  # a third are copies
    df, names = points(spark, x)
    labels = np.array([i % 3 if i < 60 else 1 for i in range(90)])
    labels[0] = 5  # a cluster of one
    table = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "id long, klaster int")
    got = clustering.silhouette(df.join(table, "id"), names, size=size).first()
    assert got.skor == pytest.approx(brute_silhouette(x, labels), abs=1e-9)


def test_silhouette_of_separated_blobs(spark):
    x = blobs([(0, 0), (10, 10)], spread=0.1)
    df, names = points(spark, x)
    labelled = clustering.assign(df, names, [[0, 0], [10, 10]])
    r = clustering.silhouette(labelled, names).first()
    assert r.skor > 0.9 and r.verdikt == "dobar"
    one = clustering.silhouette(df.withColumn("klaster", F.lit(0)), names).first()
    assert (one.skor, one.verdikt) == (0.0, "los")


def test_feature_space(items, items_pd):
    weights = {"cena": 60, "zapremina_l": 40}
    rows = clustering.feature_space(items, weights).toPandas().set_index("id")
    full = items_pd.dropna(subset=list(weights)).set_index("id")
    for c, w in weights.items():
        want = (full[c] - full[c].min()) / (full[c].max() - full[c].min()) * w / 100
        np.testing.assert_allclose(rows[f"f_{c}"].sort_index(), want.sort_index(), rtol=1e-12)
    for bad in ({"cena": 50}, {"cena": 50, "zapremina_l": 50.2}, {}):
        with pytest.raises(ValueError):
            clustering.feature_space(items, bad)
    with pytest.raises(ValueError):
        clustering.feature_space(items, {"zapremina_l": 50, "dijagonala_inch": 50}, k=4)
    clustering.feature_space(items, {"cena": 50.05, "zapremina_l": 50})


def test_presets_run(items):
    for _, k, weights in fixed.CLUSTER_PRESETS:
        labelled, centroids = clustering.k_means(items, weights, k)
        assert len(centroids) == k and set(r[0] for r in labelled.select("klaster").distinct().collect()) <= set(range(k))


def test_k_changes_the_result(items):
    sizes = {k: clustering.k_means(items, {"cena": 100}, k)[0].select("klaster").distinct().count() for k in (2, 5)}
    assert sizes == {2: 2, 5: 5}


def test_profile_names_the_chosen_columns(spark):
    df = spark.createDataFrame([(0, 45_000.0, 300.4, 7.0, None, 55.0, 1200.0), (0, 46_001.0, 300.4, 5.0, None, 56.0, 1300.0)],
                               "klaster int, cena double, zapremina_l double, energetska_klasa_num double, "
                               "kapacitet_kg double, dijagonala_inch double, snaga_w double")
    def text(*columns):
        return clustering.cluster_profile(df, list(columns)).first().opis

    assert text("zapremina_l") == "prosečna cena ≈ 45,500 RSD, prosečna zapremina ≈ 300 l"
    assert text("energetska_klasa_num") == "prosečna cena ≈ 45,500 RSD, bolje energ. klase (6.0/10)"
    assert text("kapacitet_kg", "cena") == "prosečna cena ≈ 45,500 RSD"
    assert text("dijagonala_inch", "snaga_w").endswith("prosečna dijagonala ≈ 56\", prosečna snaga ≈ 1250 W")


@pytest.mark.parametrize("n", [1, 2, 5, 6, 9])
def test_tiles_meet_once_and_equally_often(spark, n):
    rows = [(g, t, n, [100 * t + i for i in range(3)]) for g in ("a", "b") for t in range(n)]
    packed = spark.createDataFrame(rows, "g string, tile int, tiles int, x array<int>")
    met = tiles.pairs(packed, ["g"], ["x"]).collect()
    for g in ("a", "b"):
        pairs = [frozenset((r.tile, r.other)) for r in met if r.g == g]
        assert len(pairs) == len(set(pairs)) == n * (n + 1) // 2
        often = [sum(r.g == g and r.tile == t for r in met) for t in range(n)]
        assert max(often) - min(often) <= 1
    assert all((r.a_x[0], r.b_x[0]) == (100 * r.tile, 100 * r.other) for r in met)


def test_an_empty_tile_meets_nobody(spark):
    packed = spark.createDataFrame([(t, 4, [t]) for t in (0, 1, 3)], "tile int, tiles int, x array<int>")
    met = {frozenset((r.tile, r.other)) for r in tiles.pairs(packed, [], ["x"]).collect()}
    assert met == {frozenset(p) for p in [(0, 0), (1, 1), (3, 3), (0, 1), (0, 3), (1, 3)]}
