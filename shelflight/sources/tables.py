"""Reading, storing and counting tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflight.roles import CLEAN_SCHEMA, Roles, nan_to_null


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table; with ``schema`` no file is opened to find the columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def load_jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int],
              partitions: int, **options: str) -> DataFrame:
    """A database table, read in ``partitions`` ranges of its numeric ``key``."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, **options)
            .option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1])
            .option("numPartitions", partitions).load())


def specs_map(text: Column) -> Column:
    """JSON text as a map; missing text is an empty map."""
    return F.coalesce(F.from_json(text, "map<string,string>"),
                      F.create_map().cast("map<string,string>"))


def with_specs_map(df: DataFrame, column: str = Roles().specs) -> DataFrame:
    """Parse the spec column unless it is a map already."""
    if isinstance(df.schema[column].dataType, T.MapType):
        return df.withColumn(column, F.coalesce(column, F.create_map().cast("map<string,string>")))
    return df.withColumn(column, specs_map(F.col(column)))


def variant_specs(df: DataFrame, key: str, column: str) -> DataFrame:
    """``key, putanja, tip, vrednost``: every value in a column of JSON texts, with its path and type as found.

    Nothing is listed beforehand: the text becomes a variant, whose objects and lists are taken apart level by level until
    only plain values are left.  ``putanja`` joins the names by dots, places in a list are ``[i]``; ``tip`` is ``tekst``, ``broj``,
    ``logicki`` or ``prazno`` (a JSON null, whose value is NULL).  A null, empty or broken text and an empty object or list
    give no row; a plain value at the top has an empty path.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_key"), F.lit("").alias("putanja"), F.try_parse_json(F.col(column).cast("string")).alias("v"))
    rows = rows.where("v IS NOT NULL")
    kind = "CASE WHEN schema_of_variant(v) LIKE 'OBJECT%' THEN 'o' WHEN schema_of_variant(v) LIKE 'ARRAY%' THEN 'a' END"
    found = []
    while True:
        rows = rows.withColumn("_kind", F.expr(kind))
        found.append(rows.where("_kind IS NULL").select("_key", "putanja", "v"))
        deeper = rows.where("_kind IS NOT NULL")
        if deeper.isEmpty():
            break
        rows = spark.sql("""SELECT _key, v2.value AS v, CASE WHEN v2.key IS NULL THEN putanja || '[' || v2.pos || ']'
                                   WHEN putanja = '' THEN v2.key ELSE putanja || '.' || v2.key END AS putanja
                            FROM {deeper}, LATERAL variant_explode(v) AS v2""", deeper=deeper)
    tip = F.expr("""CASE schema_of_variant(v) WHEN 'STRING' THEN 'tekst' WHEN 'BOOLEAN' THEN 'logicki' WHEN 'VOID' THEN 'prazno' ELSE 'broj' END""")
    values = [part.select(F.col("_key").alias(key), "putanja", tip.alias("tip"), F.try_variant_get("v", "$", "string").alias("vrednost")) for part in found]
    return reduce(DataFrame.unionByName, values)


def variant_schema(df: DataFrame, column: str) -> DataFrame:
    """``sema``: the type that holds all JSON texts of a column, merged on the map side."""
    return df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column).cast("string"))).alias("sema"))


def typed_specs(specs: DataFrame, key: str, types: Mapping[str, str]) -> DataFrame:
    """One row per ``key`` with a typed column per path of ``variant_specs``; what does not fit the type is NULL."""
    cells = [F.max(F.when(F.col("putanja") == path, F.col("vrednost"))).try_cast(kind).alias(path) for path, kind in types.items()]
    return specs.where(F.col("putanja").isin(list(types))).groupBy(key).agg(*cells)


def to_clean_schema(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Clean offers in the stored layout: NaN as NULL, specs as JSON text, back-reference to the raw id."""
    df = nan_to_null(df)
    source = {"primarni_id": F.col(roles.id)}
    default = Roles()
    for f in default.__dataclass_fields__:
        name = getattr(roles, f)
        if name in df.columns:
            source[getattr(default, f)] = F.col(name)
    specs = source.get("sve_karakteristike")
    if specs is not None and isinstance(df.schema[roles.specs].dataType, T.MapType):
        source["sve_karakteristike"] = F.to_json(specs)
    return df.select(*[source.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CLEAN_SCHEMA])


def reload_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` by ``df`` and read it back; ``df`` must not come from ``path``."""
    target = urlparse(path).path.rstrip("/") + "/"
    if any(unquote(urlparse(f).path).startswith(target) for f in df.inputFiles()):
        raise ValueError(f"the rows come from {path}; write them elsewhere")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counts = [row_count(t).select(F.lit(name).alias("tabela"), "n") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def restore_when_empty(df: DataFrame, snapshot_path: str) -> DataFrame:
    """The stored snapshot if the table holds no row, else the table."""
    return load(df.sparkSession, snapshot_path, df.schema) if df.isEmpty() else df
