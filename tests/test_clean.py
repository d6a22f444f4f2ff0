from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflight import fixed_values as fixed
from shelflight.functions.quantiles import quantiles
from shelflight.operators import clean, merge
from shelflight.roles import CLEAN_SCHEMA, Roles, as_role_names, nan_to_null
from shelflight.sources import tables
from shelflight.streaming.upsert import UpsertTable

SCHEMA = ("id long, url string, naziv string, brend string, kategorija string, cena double, na_lageru boolean, "
          "energetska_klasa string, dijagonala_inch double, kapacitet_kg double, zapremina_l double, snaga_w double, "
          "datum_preuzimanja timestamp_ntz")
DAY = dt.datetime(2025, 3, 1)


def offers(n=20, **changes):
    """Rows that pass every rule; ``changes`` maps a column to {row: value}."""
    rows = []
    for i in range(n):
        rows.append(dict(id=i + 1, url=f"https://t/{i}", naziv=f"Rerna model R{i}", brend="OBLAK", kategorija="rerna",
                         cena=14_500.0 + 333.5 * i, na_lageru=i % 2 == 0, energetska_klasa="GFED"[i % 4], dijagonala_inch=None,
                         kapacitet_kg=6.5, zapremina_l=None, snaga_w=1850.0, datum_preuzimanja=DAY))
    for column, values in changes.items():
        for i, v in values.items():
            rows[i][column] = v
    return rows


def cleaned(spark, rows, **rules):
    return clean.clean(spark.createDataFrame(rows, SCHEMA), rules=clean.CleanRules(**rules)).collect()


def test_complete_rows_pass(spark):
    assert len(cleaned(spark, offers())) == 20


@pytest.mark.parametrize("changes", [
    {"naziv": {0: None}}, {"brend": {0: None}}, {"kategorija": {0: None}}, {"cena": {0: None}},
    {"cena": {1: 0.0}}, {"cena": {2: -100.0}}])
def test_rows_without_required_values_go(spark, changes):
    assert len(cleaned(spark, offers(10, **changes))) == 9


def test_row_without_technical_values_stays(spark):
    blank = {c: {0: None} for c in fixed.OPTIONAL_COLUMNS}
    assert len(cleaned(spark, offers(10, **blank))) == 10
    assert len(cleaned(spark, offers(10, **blank), min_filled=1)) == 9


def test_latest_of_an_address_stays(spark):
    later = {**offers(10)[0], "id": 99, "datum_preuzimanja": dt.datetime(2025, 6, 1), "cena": 16_250.0}
    rows = cleaned(spark, offers(10) + [later])
    assert len(rows) == 10 and {r.cena for r in rows if r.url == later["url"]} == {16_250.0}


def test_impossible_values_become_null(spark):
    rows = cleaned(spark, offers(10, zapremina_l={0: 2069.0, 1: 9.9, 2: 1000.0}))
    assert [r.zapremina_l for r in sorted(rows, key=lambda r: r.id)][:3] == [None, None, 1000.0]


def test_price_outliers_go(spark):
    rows = cleaned(spark, offers(20, cena={0: 99.0, 1: 2_500_000.0}))
    assert len(rows) == 18 and not {99.0, 2_500_000.0} & {r.cena for r in rows}


def test_brand_and_grade_code(spark):
    rows = cleaned(spark, offers(5, brend={0: " Vox\n"}, energetska_klasa={0: "a+++", 1: "E - Novo"}))
    got = sorted(rows, key=lambda r: r.id)
    assert (got[0].brend, got[0].energetska_klasa_num, got[1].energetska_klasa_num) == ("VOX", 10, None)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert clean.clean(empty).count() == 0
    report = clean.cleaning_report(empty, clean.clean(empty)).first()
    assert (report.before, report.dropped_pct, report.too_few) == (0, 0.0, True)


def test_cleaning_report(spark):
    before = spark.createDataFrame(offers(10, cena={0: -1.0}), SCHEMA)
    report = clean.cleaning_report(before, clean.clean(before), min_rows=9).first()
    assert (report.before, report.after, report.dropped, report.dropped_pct, report.too_few) == (10, 9, 1, 10.0, False)


def test_rows_dropped_by_each_rule(spark, tmp_path):
    rows = offers(30, cena={0: -1.0, 1: None, 2: float("nan"), 3: 9e9, 4: 0.0}, naziv={1: None, 5: None}, brend={0: None},
                  kapacitet_kg={6: 1e9, 7: None}, energetska_klasa={6: None}, snaga_w={6: None, 7: -4.0}, url={8: "u", 9: "u", 10: "u"})
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    r = clean.clean_with_report(df, f"{tmp_path}/c", rules=clean.CleanRules(min_filled=1, min_rows=20)).first()
    # Rows 0, 1, 2 (not a number is missing) and 5 lack a field, 4 has no price, 6 no technical value left, 8 and 9 came before 10.
    assert (r.bez_obaveznih, r.bez_cene, r.bez_podataka, r.ponovljeni, r.van_granica) == (4, 1, 1, 2, 1)
    assert (r.before, r.after, r.dropped, r.dropped_pct, r.too_few) == (30, 21, 9, 30.0, False)
    kept = clean.clean(df, rules=clean.CleanRules(min_filled=1))
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/c").collect())) == sorted(map(repr, kept.collect()))
    none = clean.clean_with_report(df.where("false"), f"{tmp_path}/n").first()
    assert tuple(none) == (0, 0, 0, 0.0, True, 0, 0, 0, 0, 0)


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("accuracy", [10, 200, 20_000])
def test_quantiles_are_exact(spark, by, accuracy):
    rng = np.random.default_rng(5)
    # One group and one value hold a third of all rows each; a missing key is a group as well.
    g = np.where(rng.random(900) < 0.33, "hot", rng.choice(list("abc"), 900))
    x = np.where(rng.random(900) < 0.33, 7.25, rng.lognormal(1, 1, 900))
    df = spark.createDataFrame([(str(a), float(v)) for a, v in zip(g, x)] + [("a", None), (None, 3.0), (None, 5.0), ("b", float("nan"))],
                               "g string, x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = {k: np.quantile(x[g == k], probs) for k in set(g)} | {None: np.quantile([3.0, 5.0], probs)} if by else {
        None: np.quantile(np.append(x, [3.0, 5.0]), probs)}
    rows = quantiles(df, "x", probs, by, accuracy).collect()
    assert {(r.g if by else None) for r in rows} == set(want)
    for r in rows:
        np.testing.assert_allclose(r.q, want[r.g if by else None], rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, x double")
    assert quantiles(df, "x", [0.5]).collect() == [(0, None)]
    assert quantiles(df.where("false"), "x", [0.5], ["g"]).count() == 0


def test_tukey_by_group(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", float(v)) for v in [100, 101, 102, 103, 1]]
    df = spark.createDataFrame(rows, "g string, x double")
    assert sorted(r.x for r in clean.tukey_filter(df, "x", by=["g"]).collect()) == [1, 2, 3, 4, 100, 101, 102, 103]
    without = df.union(spark.createDataFrame([(None, float(v)) for v in [5, 6, 7, 8, 900]], "g string, x double"))
    assert sorted(r.x for r in clean.tukey_filter(without, "x", by=["g"]).where("g IS NULL").collect()) == [5, 6, 7, 8]


def test_rank_filter_runs_before_the_shuffle(spark):
    df = spark.createDataFrame(offers(10), SCHEMA)
    plan = clean.keep_latest(df, "url", ["datum_preuzimanja", "id"])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:]


def test_upsert_keeps_first_and_updates_latest(spark):
    stored = offers(2, datum_preuzimanja={0: dt.datetime(2025, 1, 1)})
    batch = [{**stored[0], "id": 50, "naziv": "novo ime", "cena": None, "na_lageru": False,
              "datum_preuzimanja": dt.datetime(2025, 5, 1)}, {**stored[0], "id": 51, "url": "https://t/new"}]
    frames = [spark.createDataFrame(r, SCHEMA) for r in (stored, batch)]
    got = {r.url: r for r in merge.upsert_offers(*frames).collect()}
    assert len(got) == 3
    r = got["https://t/0"]
    # The name keeps its first value, price and stock follow the batch, a missing price too.
    assert (r.id, r.naziv, r.cena, r.na_lageru, r.datum_preuzimanja) == (
        1, "Rerna model R0", None, False, dt.datetime(2025, 5, 1))


def test_upsert_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), i, int(t), float(i)) for i, (k, t) in enumerate(zip(rng.integers(0, 5, 400) * (rng.random(400) < 0.7),
                                                                      rng.integers(0, 50, 400)))]
    df = spark.createDataFrame(rows, "k long, id long, t long, v double")
    results = [sorted(map(tuple, merge.upsert(df.repartition(n), "k", ["t", "id"], ["v", "t"]).collect())) for n in (1, 4, 16)]
    assert results[0] == results[1] == results[2]


def test_upsert_table(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), "k", ["t", "id"], ["v", "t", "m"])
    with pytest.raises(ValueError):
        table.read(spark)

    def batch(*rows):
        return spark.createDataFrame([(*r, {"a": str(r[1])}) for r in rows],
                                     "k long, id long, t long, name string, v double, m map<string,string>")

    def state():
        return {r.k: (r.id, r.name, r.v, r.m["a"]) for r in table.read(spark).collect()}

    table.write_batch(batch((1, 1, 10, "first", 1.0), (2, 2, 10, "two", 2.0)), 0)
    table.write_batch(batch((1, 3, 20, "renamed", 3.0)), 1)
    table.write_batch(batch((1, 3, 20, "renamed", 3.0)), 1)  # the same batch again
    want = {1: (1, "first", 3.0, "3"), 2: (2, "two", 2.0, "2")}
    assert state() == want
    table.compact(spark)
    assert state() == want
    table.write_batch(batch((2, 4, 5, "older", 9.0), (3, 5, 1, "three", 5.0)), 2)
    # A late offer is earlier than the stored one: it gives the name, not the price.
    assert state() == {1: want[1], 2: (4, "older", 2.0, "2"), 3: (5, "three", 5.0, "5")}


def test_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.createDataFrame([(1, 1, 10, 1.0), (1, 2, 20, None), (2, 3, 30, 3.0)], "k long, id long, t long, v double")
    table = UpsertTable(str(tmp_path / "t"), "k", ["t", "id"], ["v", "t"])
    for part in (rows.where("id < 3"), rows.where("id >= 3")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        table.start(stream, str(tmp_path / "progress")).awaitTermination()
    assert sorted((r.k, r.id, r.v) for r in table.read(spark).collect()) == [(1, 1, None), (2, 3, 3.0)]


def test_specs_map(spark):
    df = spark.createDataFrame([('{"a": "1", "b": 2}',), (None,)], "sve_karakteristike string")
    parsed = tables.with_specs_map(df)
    assert [r[0] for r in parsed.collect()] == [{"a": "1", "b": "2"}, {}]
    assert [r[0] for r in tables.with_specs_map(parsed).collect()] == [{"a": "1", "b": "2"}, {}]


def test_variant_specs(spark):
    texts = ['{"a": 1, "b": {"c": [true, null, {"d": "x"}], "e": 2.50}}', '"top"', "17", "null", "{}", "[]", "{broken", "", None, '{"a": "one"}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, specs string")
    got = sorted((tuple(r) for r in tables.variant_specs(df, "id", "specs").collect()), key=repr)
    assert got == sorted([(0, "a", "broj", "1"), (0, "b.c[0]", "logicki", "true"), (0, "b.c[1]", "prazno", None), (0, "b.c[2].d", "tekst", "x"),
                          (0, "b.e", "broj", "2.5"), (1, "", "tekst", "top"), (2, "", "broj", "17"), (3, "", "prazno", None), (9, "a", "tekst", "one")], key=repr)
    typed = tables.typed_specs(tables.variant_specs(df, "id", "specs"), "id", {"a": "int", "b.e": "double"})
    assert sorted(map(tuple, typed.collect())) == [(0, 1, 2.5), (9, None, None)]
    assert tables.variant_specs(df.where("false"), "id", "specs").count() == 0


def test_schema_of_texts(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2.5, "b": ["x"]}',), (None,), ("{",)], "specs string")
    assert tables.variant_schema(df, "specs").first()[0] == "OBJECT<a: DECIMAL(21,1), b: ARRAY<STRING>>"


def test_bucketed_upsert_shuffles_the_batch_alone(spark):
    rows = [(k, k % 7, float(v)) for v in range(3) for k in range(50)]
    first = spark.createDataFrame(rows, "k int, t int, v double").withColumn("o", F.col("v"))
    later = spark.createDataFrame([(k, 99, -1.0, 5.0) for k in range(40, 60)], "k int, t int, v double, o double")
    table = merge.BucketedTable(spark, "upsert_test", "k", ["o"], ["v", "o"], buckets=4)
    table.drop()
    try:
        table.upsert(first)
        merged = table.merged(later)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        before_scan = plan[:plan.index("upsert_test")].splitlines()
        stored = [x for x in before_scan if x.strip()]
        # The stored side goes from its scan to the join without an exchange; only the batch is shuffled.
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and stored
        table.upsert(later)
        want = merge.upsert(first.unionByName(later), "k", ["o"], ["v", "o"])
        assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.collect()))
        table.upsert(later.where("false"))
        assert table.read().count() == 60
    finally:
        table.drop()


def test_repeated_and_late_records(spark, tmp_path):
    def rows(*minutes):
        return [(k, "first", DAY + dt.timedelta(minutes=m), float(m)) for k, m in minutes]

    schema = "k int, t string, ts timestamp, v double"
    table = UpsertTable(f"{tmp_path}/t", "k", ["ts", "v"], ["v", "ts"])
    for n, batch in enumerate([rows((1, 0), (2, 1), (1, 0)), rows((1, 0), (3, 200)), rows((1, 3), (4, 201), (2, 150))]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(f"{tmp_path}/in")
        query = table.start_once(stream, f"{tmp_path}/check", "ts", ["k", "ts"], "1 hour")
        query.awaitTermination()
        state = query.lastProgress["stateOperators"]
        assert not state or state[0]["numRowsTotal"] <= 5
    got = {r["k"]: r["v"] for r in table.read(spark).collect()}
    # Minute 3 came when minute 200 had been seen, more than an hour later, and is left out; minute 150 is in time.
    assert got == {1: 0.0, 2: 150.0, 3: 200.0, 4: 201.0}


def test_clean_table_reload(spark, tmp_path, items):
    specs = items.withColumn("sve_karakteristike", F.create_map(F.lit("boja"), F.lit("bela"))).withColumn(
        "snaga_w", F.coalesce("snaga_w", F.lit(float("nan"))))
    stored = tables.to_clean_schema(specs)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    path = str(tmp_path / "clean")
    for _ in range(2):
        back = tables.reload_table(stored, path)
    assert back.count() == items.count()
    assert back.where("snaga_w IS NULL").count() == items.where("snaga_w IS NULL").count()
    assert back.first().sve_karakteristike == '{"boja":"bela"}'
    with pytest.raises(ValueError):
        tables.reload_table(spark.read.parquet(path), path)


def test_restore_when_empty(spark, tmp_path, items):
    path = str(tmp_path / "snapshot")
    items.write.parquet(path)
    assert tables.restore_when_empty(items.where("id < 0"), path).count() == items.count()
    assert tables.restore_when_empty(items.where("id < 5"), path).count() == 4


def test_roles(spark, items):
    roles = Roles(name="title", price="price")
    renamed = as_role_names(items, roles)
    assert {"title", "price"} <= set(renamed.columns) and "cena" not in renamed.columns
    nan = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], T.StructType(
        [T.StructField("d", T.DoubleType()), T.StructField("s", T.StringType())]))
    assert [r.d for r in nan_to_null(nan).collect()] == [None, 1.0]


def test_nan_is_missing(spark):
    rows = cleaned(spark, offers(10, cena={0: float("nan")}, zapremina_l={1: float("nan")}))
    assert len(rows) == 9 and [r.zapremina_l for r in rows if r.id == 2] == [None]
    loose = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert [r.x for r in clean.positive(loose, "x").collect()] == [1.0]
