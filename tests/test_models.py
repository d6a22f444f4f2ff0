from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalogue import CATALOGUE_TYPES, catalogue_frame
from shelflight.functions import scaling
from shelflight.operators import charts, regression
from shelflight.roles import Roles, nan_to_null


def column(df, name):
    return [r[0] for r in df.orderBy("i").select(name).collect()]


def series(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")


def test_min_max(spark):
    assert column(scaling.min_max(series(spark, [0.0, 5.0, 10.0, None]), ["x"]), "x") == [0.0, 0.5, 1.0, None]
    assert column(scaling.min_max(series(spark, [5.0, 5.0]), ["x"]), "x") == [0.0, 0.0]


def test_z_score(spark):
    x = np.random.default_rng(0).normal(100, 15, 300)
    got = np.array(column(scaling.z_score(series(spark, map(float, x)), ["x"]), "x"))
    np.testing.assert_allclose(got, (x - x.mean()) / x.std(ddof=1), rtol=1e-9, atol=1e-12)
    assert column(scaling.z_score(series(spark, [3.14, 3.14]), ["x"]), "x") == [0.0, 0.0]
    assert column(scaling.z_score(series(spark, [3.14]), ["x"]), "x") == [0.0]


def line(n=200, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 2))
    return x, 3 * x[:, 0] - 2 * x[:, 1] + 5 + rng.normal(0, 0.1, n)


def unscaled(names, target="y", target_mean=0.0, labels=(), levels=None):
    """A design that leaves numbers as they are."""
    same = {c: 0.0 for c in names}
    return regression.Design(target, tuple(names), tuple(labels), same, same, {c: 1.0 for c in names}, levels or {},
                             target_mean)


def dense_descent(x, y, rate, steps):
    """Plain batch descent over all rows, written out to compare with."""
    w, b, costs = np.zeros(x.shape[1]), 0.0, []
    for _ in range(steps):
        e = x @ w + b - y
        w, b = w - rate * (x.T @ e) / len(y), b - rate * e.mean()
        costs.append(((x @ w + b - y) ** 2).sum() / (2 * len(y)))
    return w, b, costs


@pytest.mark.parametrize("target_mean", [0.0, 4.7])
def test_descent_equals_row_by_row_descent(spark, target_mean):
    x, y = line()
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    model = regression.fit(df.repartition(7), unscaled(["a", "b"], target_mean=target_mean), rate=0.1, steps=150)
    w, b, costs = dense_descent(x, y, 0.1, 150)
    np.testing.assert_allclose([model.weights["a"], model.weights["b"], model.bias], [*w, b], rtol=1e-10)
    np.testing.assert_allclose(model.costs, costs, rtol=1e-9)
    assert model.costs == sorted(model.costs, reverse=True)
    scored = model.predict(df)
    assert regression.evaluate(scored, "y", "predikcija").first().r2 > 0.95


def matrix(df, design):
    """The design as a dense matrix in the order of its names."""
    long = regression.design_matrix(df, design).toPandas()
    wide = long.pivot(index="id", columns="osobina", values="vrednost")
    return wide.reindex(index=sorted(r.id for r in df.collect()), columns=design.names).fillna(0.0).to_numpy()


def test_design_by_hand(spark):
    rows = [(1, 5.0, "p", "x", 1.0, None), (2, 6.0, "q", "x", 3.0, 4.0), (3, 7.0, "q", "y", None, 4.0), (4, None, "r", "z", 9.0, 9.0)]
    df = spark.createDataFrame(rows, "id long, t double, k string, b string, u double, v double")
    design = regression.fit_design(df, "t", ["u", "v"], ["k", "b"])
    # Without the row that lacks a target: u is 1, 3 and (median) 2, v is 4 throughout.
    assert (design.medians, design.means["u"], design.deviations["u"]) == ({"u": 2.0, "v": 4.0}, 2.0, 1.0)
    assert design.names == ["u", "v", "k_q", "b_y"]
    assert matrix(df.where("id < 4"), design).tolist() == [[-1, 0, 0, 0], [1, 0, 1, 0], [0, 0, 1, 1]]


def test_labelled_descent(items, items_pd):
    design = regression.catalogue_design(items)
    model = regression.fit(items, design, rate=0.05, steps=120)
    w, b, costs = dense_descent(matrix(items, design), items_pd.cena.to_numpy(), 0.05, 120)
    np.testing.assert_allclose([model.weights[n] for n in design.names], w, rtol=1e-8)
    np.testing.assert_allclose([model.bias, *model.costs], [b, *costs], rtol=1e-9)


def test_predict_and_metrics(items, items_pd):
    model = regression.fit(items, regression.catalogue_design(items), rate=0.05, steps=50)
    x = matrix(items, model.design)
    want = x @ np.array([model.weights[n] for n in model.design.names]) + model.bias
    scored = model.predict(items).orderBy("id").toPandas()
    np.testing.assert_allclose(scored.predikcija, want, rtol=1e-9)
    e = items_pd.cena - want
    m = regression.evaluate(model.predict(items), "cena", "predikcija").first()
    assert m.rmse == pytest.approx(np.sqrt((e ** 2).mean()))
    assert m.r2 == pytest.approx(1 - (e ** 2).sum() / ((items_pd.cena - items_pd.cena.mean()) ** 2).sum())


def test_metric_identities(spark):
    def metrics(rows):
        return regression.evaluate(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()

    assert (metrics([(1.0, 1.0), (2.0, 2.0)]).r2, metrics([(1.0, 1.0), (2.0, 2.0)]).rmse) == (1.0, 0.0)
    assert metrics([(1.0, 2.0), (3.0, 2.0)]).r2 == 0.0
    assert metrics([(1.0, 3.0), (3.0, 1.0)]).r2 < 0
    assert metrics([(4.0, 1.0), (4.0, 2.0)]).r2 == 0.0


def test_split(spark):
    df = spark.range(1003)
    train, test = regression.split(df)
    ids = [{r.id for r in part.collect()} for part in (train, test)]
    assert len(ids[0]) == int(1003 * 0.8) and not ids[0] & ids[1] and len(ids[0] | ids[1]) == 1003
    again = {r.id for r in regression.split(df.repartition(11))[0].collect()}
    other = {r.id for r in regression.split(df, seed=7)[0].collect()}
    assert again == ids[0] and other != ids[0]
    for n in (0, 1, 2):
        parts = regression.split(spark.range(n))
        assert [p.count() for p in parts] == [int(n * 0.8), n - int(n * 0.8)]


def test_training_and_estimates(spark):
    pdf = catalogue_frame(200, shift=4)
    pdf["cena"] = 20_000 + 300 * pdf["zapremina_l"].fillna(0) + 5_000 * (pdf["brend"] == "BOSCH")
    df = nan_to_null(spark.createDataFrame(pdf, CATALOGUE_TYPES))
    for leak_free in (False, True):
        training = regression.train(df, steps=800, scale_on_train=leak_free)
        assert training.train.count() == 160 and training.test.count() == 40
        assert training.metrics().first().r2 > 0.8
    curve = charts.learning_curve(training.model.history(spark)).collect()
    assert len(curve) == 800 and curve[-1].trosak < curve[0].trosak
    estimates = regression.estimate(training.model, regression.sample_items(spark)).collect()
    assert len(estimates) == 3 and all(np.isfinite(r.predikcija) for r in estimates)
    bad = regression.sample_items(spark).withColumn("brend", F.lit("nepoznat"))
    with pytest.raises(ValueError):
        regression.estimate(training.model, bad)


def test_changing_the_input_changes_the_estimate(items, spark):
    model = regression.fit(items, regression.catalogue_design(items), rate=0.05, steps=200)
    sample = regression.sample_items(spark).limit(1)
    base = regression.estimate(model, sample).first().predikcija
    assert regression.estimate(model, sample.withColumn("zapremina_l", F.lit("650"))).first().predikcija != base
    assert regression.estimate(model, sample.withColumn("brend", F.lit(" lg "))).first().predikcija != base
    assert regression.estimate(model, sample.withColumn("snaga_w", F.lit("nije broj"))).first().predikcija == base


def test_missing_label_has_no_weight(spark):
    df = spark.createDataFrame([(1, None, 10.0), (2, "a", 20.0), (3, "b", 30.0)], "id long, k string, y double")
    design = regression.fit_design(df.withColumn("x", F.lit(1.0)), "y", ["x"], ["k"])
    model = regression.fit(df.withColumn("x", F.lit(1.0)), design, rate=0.1, steps=5)
    x = np.array([[0, 0], [0, 0], [0, 1]], dtype=float)
    w, b, _ = dense_descent(x, np.array([10.0, 20.0, 30.0]), 0.1, 5)
    assert model.weights["k_b"] == pytest.approx(w[1]) and model.bias == pytest.approx(b)


def test_predicted_vs_actual(spark):
    df = spark.createDataFrame([(1, 1000.0, 3000.0), (2, 2000.0, 500.0)], "id long, y double, p double")
    r = charts.predicted_vs_actual(df, "y", "p").orderBy("id").first()
    assert (r.stvarno, r.predvidjeno, r.osa_od, r.osa_do) == (1.0, 3.0, 0.5, 3.0)


def test_roles_of_the_design():
    assert Roles().technical[0] == "energetska_klasa_num"


def test_unseen_label(items):
    model = regression.fit(items, regression.catalogue_design(items), rate=0.05, steps=5)
    other = items.withColumn("brend", F.lit("NOVO"))
    assert model.predict(other).where("predikcija IS NOT NULL").count() == 0
    assert model.predict(other, unseen=0.0).where("predikcija IS NULL").count() == 0


def test_scaling_ignores_nan(spark):
    got = column(scaling.min_max(series(spark, [0.0, float("nan"), 4.0, 2.0]), ["x"]), "x")
    assert got == [0.0, None, 1.0, 0.5]


def test_saved_model_predicts_the_same(items, spark, tmp_path):
    design = regression.catalogue_design(items)
    for steps in (5, 20):  # the second replaces the first
        model = regression.fit(items, design, steps=steps)
        model.save(spark, str(tmp_path / "model"))
    again = regression.LinearModel.load(spark, str(tmp_path / "model"))
    assert (again.weights, again.bias, again.costs) == (model.weights, model.bias, model.costs)
    assert again.design == model.design
    both = [[r[0] for r in m.predict(items).orderBy("id").select("predikcija").collect()] for m in (again, model)]
    assert both[0] == both[1]


def test_no_saved_model(spark, tmp_path):
    spark.createDataFrame([], regression.MODEL_SCHEMA).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        regression.LinearModel.load(spark, str(tmp_path / "none"))
