"""The given tables seen as a catalogue.

The tables hold no appliances, so the catalogue columns are derived from them,
row for row, by expressions that Spark and the checking database both
understand.  They also bring in what the given tables lack: missing values,
unknown classes, stray blanks, zero and negative prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import ordinal_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case(value: str, results: list[str | None]) -> str:
    """``CASE value WHEN 0 THEN ...``; a missing result is NULL."""
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if r is None else "'" + r + "'") for i, r in enumerate(results))
    return f"CASE {value} {arms} END"


GRADE = case("(p_partkey * 7 + p_size) % 13", [*fixed.ENERGY_CLASSES, None, "Z", " a+ "])
SHOP = case("p_partkey % 3", list(fixed.SHOP_BASES))

CATALOGUE = {
    "id": "p_partkey",
    "url": "'https://shop.example/p/' || replace(p_name, ' ', '-') || '-' || p_partkey",
    "naziv": "p_name || ' ' || p_brand",
    "brend": "upper(p_brand)",
    "kategorija": "p_type",
    "cena": "CAST(CAST(p_retailprice * p_size AS DECIMAL(12,2)) AS DOUBLE)",
    "na_lageru": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey % 3 <> 0 END",
    "energetska_klasa": GRADE,
    "dijagonala_inch": "CASE WHEN p_type = 'PROMO' THEN CAST(20 + p_size AS DOUBLE) END",
    "kapacitet_kg": "CASE WHEN p_type = 'STANDARD' THEN 1 + CAST(p_size AS DOUBLE) / 4 END",
    "zapremina_l": "CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN CAST(p_size * 12 AS DOUBLE) END",
    "snaga_w": "CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END",
    "izvor": SHOP,
}

RAW_OFFERS = {
    "id": "event_id",
    "url": "'https://shop.example/o/' || user_id || '/' || event_type",
    "naziv": "CASE WHEN event_id % 17 <> 0 THEN event_type || ' ' || user_id END",
    "brend": "CASE WHEN event_id % 2 = 0 THEN '  Brand ' || (user_id % 9) ELSE 'BRAND ' || (user_id % 9) || ' ' END",
    "kategorija": "event_type",
    "cena": "CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 0.0 "
            "WHEN event_id % 29 = 0 THEN -value ELSE value * 100 END",
    "na_lageru": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 3 = 0 END",
    "energetska_klasa": case("event_id % 13", [*fixed.ENERGY_CLASSES, None, "Z", " a+ "]),
    "dijagonala_inch": "CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS DOUBLE) END",
    "kapacitet_kg": "CASE WHEN event_id % 4 = 0 THEN value / 10 END",
    "zapremina_l": "CASE WHEN event_id % 2 = 0 THEN value * 10 END",
    "snaga_w": "CASE WHEN event_id % 7 <> 0 THEN value * 50 END",
    "izvor": case("user_id % 3", list(fixed.SHOP_BASES)),
    "datum_preuzimanja": "ts",
}


def draw_sql(id: str, *seeds: int) -> str:
    """The number drawn for an id."""
    return f"('0x' || substr(md5({id} || ':{':'.join(map(str, seeds))}'), 1, 13))::BIGINT"


def select(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def grade_code_sql(column: str) -> str:
    return (f"CASE upper(trim({column})) "
            + " ".join(f"WHEN '{g}' THEN {i}" for i, g in enumerate(fixed.ENERGY_CLASSES, 1)) + " END")


#: Common table expressions for the checking SQL.
CATALOGUE_SQL = (f"catalogue AS (SELECT *, {grade_code_sql('energetska_klasa')} AS energetska_klasa_num "
                 f"FROM (SELECT {', '.join(select(CATALOGUE))} FROM part))")
RAW_OFFERS_SQL = f"raw_offers AS (SELECT {', '.join(select(RAW_OFFERS))} FROM events)"


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean item per part."""
    items = table(spark, sf_dir, "part").selectExpr(*select(CATALOGUE))
    return items.withColumn("energetska_klasa_num", ordinal_code(F.col("energetska_klasa")))


def raw_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One uncleaned offer per event; a user's offers of one type share an address."""
    return table(spark, sf_dir, "events").selectExpr(*select(RAW_OFFERS))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and averages, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def plain_nulls(df: DataFrame, *extra: str) -> DataFrame:
    """Flags as text and whole numbers with gaps as doubles: every client shows their NULLs alike."""
    casts = {"na_lageru": "string", "energetska_klasa_num": "double", **{c: "double" for c in extra}}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})


FLAG_SQL = "CAST(na_lageru AS VARCHAR) AS na_lageru"
CODE_SQL = "CAST(energetska_klasa_num AS DOUBLE) AS energetska_klasa_num"
