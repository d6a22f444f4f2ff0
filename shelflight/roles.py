"""Column roles and schemas of the catalogue tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflight import fixed_values as fixed


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; operators read names only from here."""

    id: str = "id"
    url: str = "url"
    name: str = "naziv"
    brand: str = "brend"
    category: str = "kategorija"
    price: str = "cena"
    list_price: str = "cena_pre_akcije"
    in_stock: str = "na_lageru"
    grade: str = "energetska_klasa"
    grade_code: str = "energetska_klasa_num"
    diagonal: str = "dijagonala_inch"
    capacity: str = "kapacitet_kg"
    volume: str = "zapremina_l"
    power: str = "snaga_w"
    specs: str = "sve_karakteristike"
    source: str = "izvor"
    fetched_at: str = "datum_preuzimanja"

    @property
    def required(self) -> list[str]:
        return [self.name, self.brand, self.category, self.price]

    @property
    def optional(self) -> list[str]:
        return [self.grade, self.diagonal, self.capacity, self.volume, self.power]

    @property
    def technical(self) -> list[str]:
        return [self.grade_code, self.diagonal, self.capacity, self.volume, self.power]


_SPECS = T.MapType(T.StringType(), T.StringType())
_MONEY = T.DecimalType(12, 2)

#: One scraped offer, as every source delivers it (id and fetch time are added on store).
OFFER_SCHEMA = T.StructType([
    T.StructField("izvor", T.StringType()),
    T.StructField("izvorni_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("naziv", T.StringType()),
    T.StructField("brend", T.StringType()),
    T.StructField("kategorija", T.StringType()),
    T.StructField("podkategorija", T.StringType()),
    T.StructField("cena", T.DoubleType()),
    T.StructField("cena_pre_akcije", T.DoubleType()),
    T.StructField("na_lageru", T.BooleanType()),
    T.StructField("energetska_klasa", T.StringType()),
    T.StructField("dijagonala_inch", T.DoubleType()),
    T.StructField("kapacitet_kg", T.DoubleType()),
    T.StructField("zapremina_l", T.DoubleType()),
    T.StructField("snaga_w", T.DoubleType()),
    T.StructField("sve_karakteristike", _SPECS),
])

#: Stored raw offers; spec map kept as JSON text.
RAW_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False)]
    + [T.StructField(f.name, _MONEY if f.name.startswith("cena") else f.dataType)
       for f in OFFER_SCHEMA if f.name != "sve_karakteristike"]
    + [T.StructField("sve_karakteristike", T.StringType()),
       T.StructField("datum_preuzimanja", T.TimestampNTZType())])

#: Stored clean offers; spec map kept as JSON text.
CLEAN_SCHEMA = T.StructType([
    T.StructField("primarni_id", T.LongType()),
    T.StructField("izvor", T.StringType()),
    T.StructField("naziv", T.StringType(), False),
    T.StructField("brend", T.StringType(), False),
    T.StructField("kategorija", T.StringType(), False),
    T.StructField("cena", _MONEY, False),
    T.StructField("na_lageru", T.BooleanType()),
    T.StructField("energetska_klasa", T.StringType()),
    T.StructField("energetska_klasa_num", T.IntegerType()),
    T.StructField("dijagonala_inch", T.DoubleType()),
    T.StructField("kapacitet_kg", T.DoubleType()),
    T.StructField("zapremina_l", T.DoubleType()),
    T.StructField("snaga_w", T.DoubleType()),
    T.StructField("sve_karakteristike", T.StringType()),
    T.StructField("datum_preuzimanja", T.TimestampNTZType()),
])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, so that comparisons behave alike."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def as_role_names(df: DataFrame, roles: Roles) -> DataFrame:
    """Rename a default-named catalogue to the names in ``roles``."""
    default = Roles()
    pairs = {getattr(default, f): getattr(roles, f) for f in default.__dataclass_fields__}
    return df.withColumnsRenamed({a: b for a, b in pairs.items() if a != b and a in df.columns})


assert fixed.TECHNICAL_COLUMNS == Roles().technical
