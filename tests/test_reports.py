from __future__ import annotations

import numpy as np
import oracle
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.operators import charts, reports, views
from shelflight.plans import ingest
from shelflight.roles import Roles, as_role_names
from shelflight.sources import collect


def test_bundle_has_ten_reports(items, tmp_path):
    bundle = reports.report_bundle(items, top30_televizori_cena={"n": 2})
    assert list(bundle) == fixed.REPORT_NAMES
    counts = reports.save_reports(bundle, str(tmp_path))
    assert counts["top30_televizori_cena"] == 2 and counts["broj_po_kategoriji"] == 3


def test_reports_like_pandas(items, items_pd):
    by = items_pd.groupby("kategorija")
    stats = {r.kategorija: r for r in reports.price_stats(items).collect()}
    for category, prices in by["cena"]:
        r = stats[category]
        assert (r.broj_proizvoda, r.min_cena, r.max_cena) == (len(prices), prices.min(), prices.max())
        assert r.prosecna_cena == pytest.approx(prices.mean(), abs=0.006)
        assert r.std_cena == pytest.approx(prices.std(), abs=0.006)
    shares = {r.kategorija: r for r in reports.grade_share(items).collect()}
    for category, codes in items_pd.dropna(subset=["energetska_klasa_num"]).groupby("kategorija")["energetska_klasa_num"]:
        assert shares[category].klasa_a_ili_bolja == (codes >= 7).sum()
        assert shares[category].procenat_klasa_a == pytest.approx(100 * (codes >= 7).mean(), abs=0.051)
    stock = {r.kategorija: r for r in reports.stock_share(items).collect()}
    for category, flags in by["na_lageru"]:
        assert (stock[category].na_lageru, stock[category].nije_na_lageru) == (flags.sum(), (~flags).sum())
    assert reports.count_price_up_to(items).first()[0] == (items_pd.cena <= 50_000).sum()
    assert reports.count_grade_at_least(items).first()[0] == (items_pd.energetska_klasa_num >= 5).sum()


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([("a", 1.00), ("a", 1.01), ("b", 2.5), ("b", 2.5)], "kategorija string, cena double")
    got = {r.kategorija: r.prosecna_cena for r in reports.price_stats(df).collect()}
    assert got == {"a": 1.01, "b": 2.5}
    brands = df.withColumnRenamed("kategorija", "brend")
    assert {r.brend: r.prosecna_cena for r in reports.dearest_brands(brands, least=2).collect()} == {"a": 1.0, "b": 3.0}


def test_size_report_order(spark):
    df = spark.createDataFrame([("frizider", v, 10.0) for v in (150.0, 200.0, 400.0, 401.0, None)] + [("x", 1.0, 1.0)],
                               "kategorija string, zapremina_l double, cena double")
    assert [(r.velicina, r.broj_proizvoda) for r in reports.by_size(df).collect()] == [
        (fixed.SIZE_SMALL, 1), (fixed.SIZE_MEDIUM, 2), (fixed.SIZE_LARGE, 1)]


def test_reports_use_roles(items):
    roles = Roles(category="cat", price="p", brand="b")
    renamed = as_role_names(items, roles)
    assert reports.count_per_category(renamed, roles).columns == ["cat", "broj_proizvoda"]
    assert reports.top_brands(renamed, roles).count() == 7


def test_share_table(spark):
    df = spark.createDataFrame([(f"k{i:02d}", 100 - i) for i in range(12)] + [("k99", 1)], "k string, broj long")
    rows = charts.share_table(df, "k").collect()
    assert len(rows) == 11 and rows[-1].k == fixed.REMAINDER and rows[-1].broj == 90 + 89 + 1
    assert sum(r.procenat for r in rows) == pytest.approx(100)
    small = charts.share_table(df.where("broj in (100, 1)"), "k").collect()
    assert [(r.k, r.natpis) for r in small] == [("k00", "99.0%"), ("k99", "")]


def test_band_histogram_keeps_empty_bands(spark):
    df = spark.createDataFrame([(1.0,), (30_000.0,), (300_000.0,)], "cena double")
    assert [(r.opseg, r.broj) for r in charts.band_histogram(df).collect()] == list(
        zip([label for _, label in fixed.PRICE_BANDS], [2, 0, 1, 0]))


def test_box_stats_like_pandas(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(50_000, 9000, 40), [500_000.0, 100.0]])
    rows = [("a", float(v)) for v in x] + [("a", None), ("b", 1.0)] + [("c", 2.0)] * 9 + [("c", None)]
    df = spark.createDataFrame(rows, "kategorija string, cena double")
    got = {r.kategorija: r for r in charts.box_stats(df).collect()}
    assert set(got) == {"a", "c"}
    y, r = x / 1000, got["a"]
    q1, q2, q3 = np.percentile(y, [25, 50, 75])
    inside = y[(y >= q1 - 1.5 * (q3 - q1)) & (y <= q3 + 1.5 * (q3 - q1))]
    assert (r.redova, r.n, r.izvan) == (43, 42, len(y) - len(inside))
    np.testing.assert_allclose([r.q1, r.medijana, r.q3, r.donji_brk, r.gornji_brk],
                               [q1, q2, q3, min(q1, inside.min()), max(q3, inside.max())])


def test_cluster_histogram_like_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.exponential(3, 200)
    rows = [(0, float(v)) for v in x] + [(1, 5.0)] * 7
    got = charts.cluster_histogram(spark.createDataFrame(rows, "klaster int, v double"), "v").collect()
    by = {k: sorted((r.deo, r.broj) for r in got if r.klaster == k) for k in (0, 1)}
    assert [n for _, n in by[0]] == np.histogram(x, 20)[0].tolist()
    assert [n for _, n in by[1]] == np.histogram([5.0] * 7, 20)[0].tolist()


def test_scatter_drops_incomplete_points(items, items_pd):
    got = charts.scatter(items, "zapremina_l", ["frizider", "televizor"])
    assert got.count() == items_pd.zapremina_l.notna().sum()
    r = got.first()
    assert r.y * 1000 == pytest.approx(items_pd.set_index("id").cena[r.id])


def test_views(items, items_pd):
    r = views.overview(items).first()
    assert (r.ukupno, r.kategorija, r.brendova) == (60, 3, 7)
    assert r.procenat_sa_klasom == pytest.approx(100 * items_pd.energetska_klasa_num.notna().mean())
    assert views.overview(items.where("id < 0")).first().procenat_sa_klasom == 0
    shown, count = views.browse(items, category="televizor", n=3)
    want = items_pd[items_pd.kategorija == "televizor"].sort_values("cena", ascending=False)
    assert [x.id for x in shown.collect()] == want.id.head(3).tolist() and count.first()[0] == len(want)
    assert [x[0] for x in views.category_list(items).collect()] == sorted(items_pd.kategorija.unique())
    sizes = [x.broj for x in views.largest_categories(items).collect()]
    assert sizes == sorted(sizes)
    assert views.by_id(items, 3).first().id == 3
    with pytest.raises(ValueError):
        views.by_id(items, 999)


def test_first_examples_like_pandas(items, items_pd):
    want = items_pd.groupby("kategorija").first()
    for r in views.first_examples(items).collect():
        for c in ("id", "naziv", "energetska_klasa_num", "zapremina_l", "snaga_w"):
            a, b = r[c], want.loc[r.kategorija, c]
            assert a == b or (a is None and pd.isna(b))


def test_sorting(spark):
    df = spark.createDataFrame([(1, "b", "1,200 RSD"), (2, "A", "n/a"), (3, "c", "900 RSD")], "id long, t string, p string")
    assert [r.id for r in views.sort_view(df, "p", True).collect()] == [2, 3, 1]
    assert [r.id for r in views.sort_view(df, "p", True, descending=True).collect()] == [1, 3, 2]
    assert [r.id for r in views.sort_view(df, "t", False).collect()] == [2, 1, 3]


def test_running_total_over_many_pages(spark):
    rows = [("s", p, p % 3 == 0) for p in range(50) for _ in range(2)] + [("t", 7, True)]
    df = spark.createDataFrame(rows, "izvor string, strana long, ok boolean")
    for span in (1, 7, 1000):
        got = {(r.izvor, r.strana): r.ukupno for r in
               collect.collection_summary(df, "izvor", "strana", F.col("ok"), span=span).collect()}
        total = 0
        for p in range(50):
            total += 2 * (p % 3 == 0)
            assert got[("s", p)] == total
        assert got[("t", 7)] == 1


def test_running_total_follows_the_listing(spark):
    rows = [("s", "z", 1, 1, True), ("s", "z", 1, 2, True), ("s", "a", 2, 1, True), ("s", "a", 2, 1, False), ("t", "a", 2, 1, True)]
    df = spark.createDataFrame(rows, "izvor string, kategorija string, redosled int, strana long, ok boolean")
    for span in (1, 1000):
        found = collect.collection_summary(df, "izvor", "strana", F.col("ok"), "kategorija", "redosled", span)
        assert sorted(tuple(r) for r in found.select("izvor", "redosled", "strana", "upisano", "vidjeno", "ukupno").collect()) == [
            ("s", 1, 1, 1, 1, 1), ("s", 1, 2, 1, 1, 2), ("s", 2, 1, 1, 2, 3), ("t", 2, 1, 1, 1, 1)]


def test_summary_keeps_missing_and_unlisted_categories(spark):
    rows = [("s", "a", 1, 1, True), ("s", "x", None, 1, True), ("s", "x", None, 2, True), ("s", "y", None, 1, True),
            ("s", None, None, 1, False), ("s", None, None, None, True), (None, "a", 1, 1, True)]
    df = spark.createDataFrame(rows, "izvor string, kategorija string, redosled int, strana long, ok boolean")
    for span in (1, 1000):
        found = collect.collection_summary(df, "izvor", "strana", F.col("ok"), "kategorija", "redosled", span)
        got = {tuple(r) for r in found.select("izvor", "kategorija", "strana", "upisano", "vidjeno", "ukupno").collect()}
        assert got == {("s", "a", 1, 1, 1, 1), ("s", "x", 1, 1, 1, 3), ("s", "y", 1, 1, 1, 3), ("s", None, 1, 0, 1, 3),
                       ("s", "x", 2, 1, 1, 4), ("s", None, None, 1, 1, 5), (None, "a", 1, 1, 1, 1)}


def test_summary_of_pages_without_lang_or_html(spark, tmp_path):
    long = "x" * 4000
    rows = [(0, "http://a.org/0", f'<html lang="en">{long}'), (1, "http://a.org/1", f"<html>{long}"), (2, "http://a.org/2", None),
            (3, "http://a.com/3", None), (6, "http://a.org/6", f"<p>{long}"), (7, "http://a.org/7", f'<html lang="fr">{long}'),
            (11, "http://a.org/11", f'<html lang="it">{long}'), (12, None, f'<html lang="de">{long}'), (13, "no address", long)]
    pd.DataFrame(rows, columns=["page_id", "url", "html"]).to_parquet(tmp_path / "pages.parquet")
    con = oracle.database(str(tmp_path))
    for name in ("a12_collection_summary", "a12_source_totals"):
        assert oracle.compare(ingest.QUERIES[name](spark, str(tmp_path)), ingest.SQL[name], con) is None
    con.close()


def test_overview_from_parts(spark, items):
    """Parts of loads, stored one after another, give the overview of all rows."""
    whole = views.overview(items).first()
    loads = items.withColumn("load", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b"))
    parts = [views.overview_parts(loads.where(F.coalesce(F.col("load"), F.lit("-")) == k), "load") for k in ("a", "b", "-")]
    got = views.overview_of_parts(parts[0].unionByName(parts[1]).unionByName(parts[2])).first()
    assert got.asDict() == pytest.approx(whole.asDict())
    nothing = views.overview_of_parts(views.overview_parts(loads.where("false"), "load")).first()
    assert (nothing["ukupno"], nothing["brendova"], nothing["min_cena"], nothing["procenat_sa_klasom"]) == (0, 0, None, 0.0)


def test_overview_from_parts_is_near_for_many_values(spark):
    rows = spark.range(60_000).selectExpr("id", "concat('b', id % 50000) AS brend", "'c' AS kategorija", "1.0 AS cena",
                                          "1.0 AS energetska_klasa_num", "id % 4 AS load")
    got = views.overview_of_parts(views.overview_parts(rows, "load")).first()
    assert got["ukupno"] == 60_000 and abs(got["brendova"] - 50_000) < 50_000 * 4 * 1.04 / 128


def test_grid_pyramid(spark):
    rng = np.random.default_rng(3)
    rows = [(float(x), float(y)) for x, y in rng.normal(size=(500, 2))] + [(None, 1.0), (1.0, None), (float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = {(r["nivo"], r["kx"], r["ky"]): r["broj"] for r in charts.grid_pyramid(df, "x", "y", 3).collect()}
    xy = np.array(rows[:500])
    part = (xy - xy.min(0)) / (xy.max(0) - xy.min(0))
    want = {}
    for level in range(4):
        for kx, ky in np.minimum(np.floor(part * 2**level), 2**level - 1).astype(int).tolist():
            want[level, kx, ky] = want.get((level, kx, ky), 0) + 1
    assert got == want


def test_grid_pyramid_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(2.0, 5.0)] * 3, "x double, y double")
    got = sorted(map(tuple, charts.grid_pyramid(df, "x", "y", 1).collect()))
    assert got == [(0, 0, 0, 3), (1, 1, 1, 3)]
    assert charts.grid_pyramid(df.where("false"), "x", "y").count() == 0
