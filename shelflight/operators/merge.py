"""Upsert of offers by key as one mergeable aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight.roles import Roles


def updated_columns(roles: Roles = Roles()) -> list[str]:
    """Columns that a later offer replaces; all others keep their first value."""
    return [roles.price, roles.list_price, roles.in_stock, roles.specs, roles.fetched_at]


def upsert(df: DataFrame, key: str, order: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per key: ``latest`` columns from its last row, the others from its first.

    ``order`` says which row is earlier and ends with a unique column.  A missing
    value in the deciding row is kept.  Both ends are combined on the map side, so
    a hot key costs one row per input partition.
    """
    first = [c for c in df.columns if c != key and c not in latest]
    last = [c for c in df.columns if c in latest]
    position = F.struct(*order)
    ends = df.groupBy(key).agg(
        F.min_by(F.struct(*first), position).alias("_first"),
        F.max_by(F.struct(*last), position).alias("_last"))
    return ends.select(*[F.col(key) if c == key else F.col(f"{'_last' if c in latest else '_first'}.{c}")
                         for c in df.columns])


class BucketedTable:
    """One row per key in a table that is stored in buckets of the key.

    An upsert folds the batch and joins it to the stored rows bucket by bucket: the batch is shuffled, the table, which
    is much larger, is not.  The stored rows are those of ``upsert``: the columns in ``latest`` from the last row of a
    key and the others from the first, as ``order`` has it, whose columns are among ``latest``.  A key is not NULL.

    Two tables take turns, since a table cannot be written while it is read; the catalogue says which one holds.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, order: Sequence[str], latest: Sequence[str], buckets: int = 64):
        if not set(order) <= set(latest):
            raise ValueError("the order of a stored row is told by columns that the latest row brings")
        self.spark, self.name, self.key, self.order, self.latest, self.buckets = spark, name, key, list(order), list(latest), buckets

    def _sides(self) -> tuple[str | None, str]:
        """The table that holds, and the one to write next."""
        one, other = f"{self.name}_0", f"{self.name}_1"
        if self.spark.catalog.tableExists(one):
            return one, other
        return (other if self.spark.catalog.tableExists(other) else None), one

    def read(self) -> DataFrame:
        held, _ = self._sides()
        if held is None:
            raise ValueError(f"nothing has been written to {self.name}")
        return self.spark.table(held).drop(*self._firsts())

    def _firsts(self) -> list[str]:
        return [f"_first_{c}" for c in self.order]

    def merged(self, batch: DataFrame) -> DataFrame:
        """The stored rows with the batch: what ``upsert`` writes."""
        first = [c for c in batch.columns if c != self.key and c not in self.latest]
        at, began = F.struct(*self.order), F.struct(*[F.col(c).alias(f"_first_{c}") for c in self.order])
        ends = batch.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(
            F.min_by(F.struct(began.alias("at"), *first), at).alias("_f"), F.max_by(F.struct(*self.latest), at).alias("_l"))
        held, _ = self._sides()
        if held is None:
            return ends.select(self.key, *[f"_f.{c}" for c in first], *[f"_l.{c}" for c in self.latest], "_f.at.*")
        stored = self.spark.table(held).withColumn("_stored", F.lit(True))
        met = stored.join(ends.withColumnRenamed(self.key, "_key").hint("merge"), stored[self.key] == F.col("_key"), "full")
        own_first, own_last = F.struct(*self._firsts()), F.struct(*[stored[c] for c in self.order])
        earlier = F.col("_stored").isNull() | (F.col("_f.at") < own_first)
        later = F.col("_stored").isNull() | (F.struct(*[F.col(f"_l.{c}") for c in self.order]) >= own_last)
        there = F.col("_key").isNotNull()
        pick = lambda new, taken, old: F.when(there & taken, F.col(new)).otherwise(old)
        return met.select(
            F.coalesce(stored[self.key], "_key").alias(self.key), *[pick(f"_f.{c}", earlier, stored[c]).alias(c) for c in first],
            *[pick(f"_l.{c}", later, stored[c]).alias(c) for c in self.latest],
            *[pick(f"_f.at.{c}", earlier, stored[c]).alias(c) for c in self._firsts()])

    def upsert(self, batch: DataFrame) -> None:
        held, fresh = self._sides()
        rows = self.merged(batch).repartition(self.buckets, self.key) if held is None else self.merged(batch)
        rows.write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(fresh)
        if held is not None:
            self.spark.sql(f"DROP TABLE {held}")

    def drop(self) -> None:
        for side in (f"{self.name}_0", f"{self.name}_1"):
            self.spark.sql(f"DROP TABLE IF EXISTS {side}")


def upsert_offers(stored: DataFrame, batch: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Merge a batch of offers into stored ones by url."""
    both = stored.unionByName(batch, allowMissingColumns=True)
    return upsert(both, roles.url, [roles.fetched_at, roles.id],
                  [c for c in updated_columns(roles) if c in both.columns])
